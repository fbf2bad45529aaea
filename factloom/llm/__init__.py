"""Training-data operators: sharding, quality, deduplication, chat, packing, WARC, language and URL rules.

Nothing outside this subpackage imports it. Each module holds one operator with
its general interface; `queries` holds the thin registered queries and their SQL.
"""
