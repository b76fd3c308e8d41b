"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import public_tokenizers
import pytest

from tallymark.llm import bpe, fingerprint, forest, html_text, lm, mixing, quality, token_counts, toxicity, warc
from tallymark.llm.registry import ship_package
from tests.llm import odd

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_quality(spark):
    docs = odd.frame(spark)
    found = by_id(quality.judge(docs, quality.learn_references(docs)))
    assert sum(map(len, found.values())) == len(odd.ROWS)
    assert found[1][0]["n_words"] == 0 and found[1][0]["base_failed"] and not found[1][0]["kept"]
    assert found[3][0]["word_chars"] == 0
    assert found[5][0] == found[5][1]
    assert found[7][0]["n_words"] == 30_000 and found[7][0]["base_failed"]  # it repeats itself
    nothing = odd.empty(spark)
    assert quality.judge(nothing, quality.learn_references(nothing)).collect() == []


def test_mixing(spark):
    docs = odd.frame(spark)
    found = by_id(mixing.mix(docs, mixing.word_count(docs["text"])))
    assert sum(map(len, found.values())) == len(odd.ROWS)
    assert found[1][0]["size"] == 0 and found[1][0]["taken"] == 0
    assert found[1][0]["source_size"] == 12  # NULL sources are one source
    assert all(r["taken"] <= 2 * r["size"] for rs in found.values() for r in rs)
    assert found[7][0]["od.d"] == "x"
    nothing = odd.empty(spark)
    assert mixing.mix(nothing, mixing.word_count(nothing["text"])).collect() == []


def test_bpe_and_token_counts(spark):
    docs = odd.frame(spark)
    found = by_id(bpe.encode_decode(docs, WORD_BPE))
    assert found[1][0]["n_tokens"] == 0 and found[1][0]["decoded"] == "" and found[3][0]["n_tokens"] == 0
    assert found[8][0]["decoded"].endswith("<|endoftext|>")
    assert found[5][0]["token_ids"] == found[6][0]["token_ids"]
    counted = by_id(token_counts.count_tokens(docs, PIECES))
    assert counted[2][0]["n_tokens"] == 0 and counted[7][0]["n_words"] == 30_000
    assert bpe.encode_decode(odd.empty(spark), WORD_BPE).collect() == []
    assert token_counts.count_tokens(odd.empty(spark), PIECES).collect() == []


def test_fingerprints(spark):
    docs = odd.frame(spark)
    found = by_id(fingerprint.fingerprints(docs))
    assert found[1][0]["fingerprint"] == found[3][0]["fingerprint"] != found[4][0]["fingerprint"]
    compared = by_id(fingerprint.compare_edited(docs))
    assert sum(map(len, compared.values())) == len(odd.ROWS)
    assert compared[5][0]["fingerprint"] == compared[6][0]["fingerprint"]
    assert fingerprint.compare_edited(odd.empty(spark)).collect() == []


def test_forest(spark):
    found = by_id(forest.link(odd.frame(spark)))
    assert sum(map(len, found.values())) == len(odd.ROWS)
    for alone in (1, 2, 3, 4, 7, 8):
        assert found[alone][0]["n_links"] == 0 and found[alone][0]["class_id"] == alone
    assert [r["n_links"] for r in found[5]] == [2, 2] and found[6][0]["class_id"] == 5
    assert forest.link(odd.empty(spark)).collect() == []
    kept = sorted(str(r["doc_id"]) for r in forest.keep_one(odd.frame(spark)).collect())
    assert kept == ["1", "2", "3", "4", "5", "5", "7", "8", "None"]


def test_language_model(spark):
    docs = odd.frame(spark)
    held = docs["doc_id"].eqNullSafe(4)
    found = by_id(lm.score(docs, held, lm.train(docs.filter(~held).select("text"))))
    assert sum(map(len, found.values())) == len(odd.ROWS)
    assert found[1][0]["n_tokens"] == 1 and found[1][0]["n_known"] == 1
    assert found[4][0]["held_out"] and found[4][0]["n_known"] == 1
    nothing = odd.empty(spark)
    assert lm.score(nothing, nothing["doc_id"] == 1, lm.train(nothing.select("text"))).collect() == []
    untaught = by_id(lm.score(docs, held, lm.train(nothing.select("text"))))
    assert untaught[7][0]["n_known"] == 0 and untaught[7][0]["base_score"] == 0.0


def test_toxicity(spark):
    docs = odd.frame(spark)
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, None), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    found = by_id(toxicity.score(docs, toxicity.learn(docs, labels)))
    assert sum(map(len, found.values())) == len(odd.ROWS)
    assert 0 <= found[1][0]["score"] < 0.5 and found[1][0]["predicted"] == 0
    assert found[5][0] == found[5][1]
    nothing = odd.empty(spark)
    assert toxicity.score(nothing, toxicity.learn(nothing, labels.limit(0))).collect() == []


PAGES = [
    (1, None, None, "x"), (2, "http://a b\r\nc", "", "x"), (3, "u", "<p>" + "long text, " * 20_000, "x"),
    (4, "u", "<p>" + "same payload " * 100, "x"), (4, "u", "<p>" + "same payload " * 100, "x"),
    (5, None, "<p>" + "same payload " * 100, "x"), (None, "u", "<p>" + "same payload " * 100, "x"), (6, "u", "small", "x"),
    (7, "u", "small", "x"), (8, "u", "<div><p>unclosed <b>bold &amp &lt; \U0001f642 <a href='x>y'>l</a><p", "x"),
]
PAGE_SCHEMA = "page_id bigint, url string, html string, text string"


def test_pages(spark):
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA)
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert found[1] == "" and found[2] == "" and found[6] == "small"
    assert len(found[3]) == len("long text, " * 20_000) - 1
    assert found[8].startswith("unclosed bold & < \U0001f642 l")
    assert html_text.extract(pages.limit(0)).collect() == []


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA)
    archives = warc.write_archives(pages)
    found = {}
    for r in warc.read_records(archives).collect():
        found.setdefault(r["page_id"], []).append(r)
    assert sum(map(len, found.values())) == len(PAGES)
    assert found[1][0]["payload_bytes"] == 0 and found[1][0]["payload"] == b"" and found[1][0]["record_type"] == "response"
    assert [r["record_type"] for r in found[4]] == ["revisit"] * 2 and found[4][0]["refers_to"] == 5
    assert found[None][0]["record_type"] == "revisit" and found[5][0]["record_type"] == "response"
    assert bytes(found[3][0]["payload"]).decode() == PAGES[2][2]
    assert found[6][0]["record_type"] == found[7][0]["record_type"] == "response"
    one = warc.read_records(archives, archives.index.filter("page_id = 3")).collect()
    assert [r["page_id"] for r in one] == [3]
    assert warc.read_records(warc.write_archives(pages.limit(0))).collect() == []
