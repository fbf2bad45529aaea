"""The language model learns every language there is."""

import zlib

from factloom.llm import langid


def test_more_than_500_languages(spark):
    rows = [(i, f"text of language {i}", f"l{i:03d}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.fit(docs).names == [lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != langid.HELD_OUT]
