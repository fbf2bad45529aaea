"""Word lists, weights, patterns, formats and texts that results depend on. They are data, given as they must be."""

from __future__ import annotations

# --- fixed values: page scoring ---------------------------------------------------------------------------------
RULES = [
    ("annual_report", 25, ["annual report", "annual reports", "annual-report", "annual-reports", "annual review", "annual-review", "annualreport", "reportsannual"]),
    ("10-K", 18, ["10-k", "10k", "form 10-k", "form 10k"]),
    ("sec_filings", 8, ["sec filings", "sec-filings", "secfilings", "sec filing", "sec-filing"]),
    ("investor_relations", 6, ["investor relations", "investor-relations", "investors", "shareholder", "shareowners"]),
    ("financial_reports", 10, ["financial reports", "financial report", "financial information", "financial-information", "financials", "financial results", "financial-results", "financial statements", "financial-statements", "financial highlights", "financial-highlights"]),
]
NEGATIVE_KEYWORDS = ["privacy", "security", "careers", "jobs", "press", "news", "branch", "location", "atm", "cookies", "disclosure", "fraud"]
NEGATIVE_PENALTY = 8
LEVELS = [("HIGH", 30), ("MEDIUM", 15), ("LOW", 5)]
MAX_DEPTH, MAX_PAGES = 2, 40

# --- fixed values: domains and links ----------------------------------------------------------------------------
ALLOWED_ROOTS = ["sec.gov", "q4cdn.com", "s1.q4cdn.com", "q4ir.com", "materials.proxyvote.com", "gcs-web.com", "corporate-ir.net", "services.corporate-ir.net", "s3.amazonaws.com"]
START_URLS = {
    "FMStBank": "https://ir.fm.bank/fms",
    "gntybank": "https://www.gnty.com/investors/",
    "AlwaysOurBest": "https://investors.skylinenationalbank.com/financials/annual-reports/default.aspx",
    "EphrataNational": "https://enbfinancial.q4ir.com/financial-information/annual-reports-and-documents/default.aspx",
    "CapitalOne": "https://investor.capitalone.com/financial-results/annual-reports",
}
IR_PATTERNS = [r"(^|\.)ir\.", r"(^|\.)investor", r"q4cdn", r"q4web", r"q4inc", r"broadridge", r"app\.q4web"]
ASSET_SUFFIXES = ["pdf", "jpg", "jpeg", "png", "gif", "css", "js", "ico"]
EXPAND_URL_FIRST = ["investor", "investors", "financial", "financials", "sec", "filing", "reports", "annual", "ir"]
EXPAND_TEXT_FIRST = ["investor", "financial", "annual", "10-k", "10k", "report", "ir"]
EXPAND_URL_DEEPER = ["annual", "report", "10-k", "10k", "sec-filings", "secfilings", "financial-report", "financial-reports", "financials", "sec"]
EXPAND_TEXT_DEEPER = ["annual", "10-k", "10k", "financial", "report"]
EXPAND_URL_SIMPLE = ["annual", "report", "10-k", "10k", "sec-filings", "financials", "financial-information"]
NOT_REPORTS = ["patriot", "switch-kit", "switch kit", "schedule-of-fees", "schedule of fees", "fee schedule", "feeschedule", "forms", "form ", "application", "charter", "bylaws", "policy", "policies", "privacy", "terms-and-conditions", "terms and conditions", "loan-application", "account-agreement"]
SIMPLE_LINK_WEIGHTS = [("annual", 4), ("10-k", 4), ("10k", 4), ("report", 2), ("financial", 2), ("sec", 1), ("statement", 1)]
YEAR_WORD = r"\b(19[0-9]{2}|20[0-9]{2})\b"
YEAR_RECENT = r"(20[01][0-9]|202[0-5])"

# --- fixed values: chunks and retrieval -------------------------------------------------------------------------
CHUNK_SIZE, CHUNK_OVERLAP, MAX_CHUNKS, MIN_CHARS = 1400, 200, 50_000, 50
METRICS = ["ROA", "ROE", "NIM", "NII", "Provision for Credit Losses"]
BLOCK_BREAK = "\n\n---\n\n"
RATIO_PHRASES = ["selected performance ratios", "return on assets", "return on equity", "equity to assets", "dividend payout", "net interest margin"]
QUERY_BANK = {
    "NIM": ["{bank} net interest margin {year}", "net interest margin {year}", "NIM net interest margin", "tax-equivalent net interest margin", "net interest margin (nim)"],
    "NII": ["{bank} net interest income {year}", "net interest income {year}", "NII net interest income", "net interest income (nii)"],
    "ROA": ["{bank} return on assets {year}", "return on assets {year}", "ROA return on assets", "ROAA return on average assets", "return on average assets", "Selected Performance Ratios return on assets 2024", "Selected Performance Ratios return on equity 2024", "Other Data at Year-end Selected Performance Ratios", "Equity to Assets Dividend Payout Return on Assets Return on Equity", "ROAA ROAE Selected Performance Ratios", "FY2024 return on average assets ROA performance ratios selected performance ratios"],
    "ROE": ["{bank} return on equity {year}", "return on equity {year}", "ROE return on equity", "ROAE return on average equity", "return on average equity", "Selected Performance Ratios return on assets 2024", "Selected Performance Ratios return on equity 2024", "Other Data at Year-end Selected Performance Ratios", "Equity to Assets Dividend Payout Return on Assets Return on Equity", "ROAA ROAE Selected Performance Ratios", "FY2024 return on average equity ROE performance ratios selected performance ratios"],
    "Provision for Credit Losses": ["{bank} provision for credit losses {year}", "provision for credit losses {year}", "provision for credit losses", "provision for loan losses", "credit loss expense", "allowance for credit losses provision"],
}
METRIC_SYNONYMS = {
    "Return on Average Assets": "ROA", "Return on Assets": "ROA", "ROAA": "ROA", "Return on Average Equity": "ROE", "Return on Equity": "ROE", "ROAE": "ROE",
    "Net Interest Margin": "NIM", "NIM": "NIM", "Net Interest Income": "NII", "NII": "NII", "Provision for Credit Losses": "Provision for Credit Losses", "Provision for credit losses": "Provision for Credit Losses",
}

# --- fixed values: extraction patterns --------------------------------------------------------------------------
HEADER = r"\[k=.*?\|stem=.*?\|chunk=(\d+)\]"
NII_VALUE = r"(?:net\s+interest\s+income|NII)\b.{0,160}?(\(?-?\$?\s*\d{1,3}(?:,\d{3})+(?:\.\d+)?\)?|\(?-?\$?\s*\d+(?:\.\d+)?\)?)"
PERCENT = r"(\d{1,2}(?:\.\d{1,4})?)\s*%"
NIM_WORDS = r"(net\s+interest\s+margin|interest\s+margin|\bNIM\b)"
ROA_WORDS = r"(return\s+on\s+(?:average\s+)?(?:total\s+)?assets|\bROA\b|\bROAA\b)"
ROE_WORDS = r"(return\s+on\s+(?:average\s+)?(?:common\s+)?(?:shareholders[’']?\s+)?equity|\bROE\b|\bROAE\b)"
JOINT_RATIOS = r"return\s+on\s+average\s+assets\s+and\s+equity\s+were\s+(\d{1,2}(?:\.\d{1,4})?)\s*%\s+and\s+(\d{1,2}(?:\.\d{1,4})?)\s*%.*?respectively"
SCALE_THOUSAND = r"\$\s*in\s*thousands|\$\s*\(?\s*000s?\)?|\bin\s*\$0{3}s\b|\(\s*\$0{3}s?\s*\)"
SCALE_MILLION = r"\$\s*in\s*millions|\bin\s*\$0{6}s\b|\(\s*\$0{6}s?\s*\)"
MONEY_COMMAS = r"(?<!\d)(\(?\$?\d{1,3}(?:,\d{3})+(?:\.\d+)?\)?)(?!\d)"
MONEY_PLAIN = r"(?<!\d)(\(?\$?\d+(?:\.\d+)?\)?)(?!\d)"
SUMMARY_TITLE, SUMMARY_STOPS = "Summary of Operations", ["Year-end Balances", "Average Balances", "Per Share Data", "Selected Performance Ratios"]
AVERAGE_TITLE, AVERAGE_STOPS = "Average Balances", ["Per Share Data", "Selected Performance Ratios", "Other Data at Year-end", "Year-end Balances"]
ASSET_LABELS = ["Average Total Assets", "Average total assets", "Avg Total Assets", "Average Assets"]
EQUITY_LABELS = ["Average Shareholders' Equity", "Average Shareholders’ Equity", "Average Stockholders' Equity", "Average stockholders’ equity", "Average equity"]
