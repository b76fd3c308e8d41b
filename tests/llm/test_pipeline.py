"""Each stage of the pipeline against a computation of its own on the stage's input, and the stages on odd inputs."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallymark.llm import toxicity
from tallymark.llm.queries import MIXING_SQL, QUALITY_SQL
from tallymark.llm.registry import ship_package, table
from tests.llm import odd


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows that go into each stage and come out of it."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.stash(stage(spark, docs, sf_dir), "test-stages")
        out[name] = (docs, kept)
        docs = kept
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def in_duckdb(docs, sql):
    con = duckdb.connect()
    frame = docs.select("doc_id", "text", "lang", "source").toPandas()
    con.register("documents_given", frame)
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text, lang, source FROM documents_given")
    return con.execute(sql)


def test_quality_stage_equals_its_sql(stages):
    before, after = stages["quality"]
    found = in_duckdb(before, f"SELECT doc_id FROM ({QUALITY_SQL}) q WHERE kept").fetchall()
    assert ids(after) == Counter(d for d, in found) and 0 < after.count() < before.count()


def test_toxicity_stage_drops_what_the_model_says(spark, sf_dir, stages):
    """The model is learnt from the stage's own input and the labels that teach; each text is then scored in this process."""
    before, after = stages["toxicity"]
    labels = [r for r in table(spark, sf_dir, "labels").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0]
    teach = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in labels], "doc_id bigint, toxic int")
    scorer = toxicity.Scorer(toxicity.learn(before, teach))
    clean = Counter(r["doc_id"] for r in before.collect() if scorer.score(r["text"] or "") < 0.5)
    assert ids(after) == clean and after.count() < before.count()


def test_near_copies_stage_keeps_one_of_each_class(stages):
    before, after = stages["near copies"]
    sets, parent = {}, {}
    for r in before.collect():
        ws = (r["text"] or "").encode().split()
        sets[r["doc_id"]] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()
        parent[r["doc_id"]] = r["doc_id"]

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d, grams in sets.items():
        for g in grams:
            holders[g].append(d)
    common = Counter((a, b) for ds in holders.values() for a in ds for b in ds if a < b)
    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    assert ids(after) == Counter({top(d) for d in sets}) and after.count() < before.count()


def test_mixing_stage_equals_its_sql(stages):
    """A document stays once for each epoch that takes from it, whole."""
    before, after = stages["mixing"]
    mixed = in_duckdb(before, MIXING_SQL)
    names = [d[0] for d in mixed.description]
    want = Counter()
    for row in mixed.fetchall():
        r = dict(zip(names, row))
        if r["taken"]:
            want[r["doc_id"]] += -(-r["taken"] // r["size"])
    assert ids(after) == want and max(want.values()) <= 2


def test_bpe_stage_equals_the_library(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r["doc_id"]: r["text"] or "" for r in before.collect()}
    assert ids(after) == ids(before)
    for r in after.dropDuplicates(["doc_id"]).collect():
        found = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert bytes(r["token_ids"]) == struct.pack(f"<{len(found)}I", *found) and r["n_tokens"] == len(found)
        decoded = library.decode(found, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_inputs(spark, sf_dir, name):
    """NULLs in any column, empty and very long texts, repeated rows, an empty table, columns named like results."""
    ship_package(spark)
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd.frame(spark).unionByName(odd.frame(spark, [(None, None, None, None, None, None)]))
    result = stage(spark, docs, sf_dir)
    after = result.collect()
    if name == "bpe":
        assert len(after) == len(odd.ROWS) + 1 and {r["n_tokens"] for r in after if r["doc_id"] in (1, 2, 3)} == {0}
    else:
        assert result.columns == docs.columns
    if name == "toxicity":
        assert len(after) == len(odd.ROWS) + 1  # none of them is toxic
    if name == "near copies":
        copies = [r["doc_id"] for r in after if r["text"] and re.match("the same text again", r["text"])]
        assert copies in ([5], [5, 5])
    assert stage(spark, odd.empty(spark), sf_dir).collect() == []
