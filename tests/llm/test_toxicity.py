"""Toxicity: disguises that are letters alone, evidence against brute force, and exact counts."""

from collections import Counter

import numpy as np
import pytest
import xxhash

from tallymark.llm import toxicity
from tallymark.llm.registry import ship_package, table
from tallymark.llm.text import mix64, windows
from tallymark.llm.toxicity import ALPHABET, CharModel, Learning, Restorer, Scorer, ToxicityModel, bigram_counts, features, join_spaced

PLAIN = "you are the one with a stupid idiot of a loser who is in there and that other trash, a bookkeeper of the committee " * 30


@pytest.fixture(scope="module")
def chars():
    return CharModel.from_counts(bigram_counts(PLAIN).reshape(ALPHABET, ALPHABET).astype(float))


@pytest.mark.parametrize(("written", "word"), [
    ("iiddiioott", "idiot"), ("ssttuuppiidd", "stupid"), ("ídiot", "idiot"), ("ｉｄｉｏｔ", "idiot"), ("ѕtupid", "stupid"),
    ("idíöt", "idiot"), ("lоsеr", "loser"), ("1d10t", "idiot"), ("idiot", "idiot"), ("bookkeeper", "bookkeeper"),
    ("committee", "committee"), ("стул", "стул"), ("ñandú", "nandu"), ("한국", "한국"),
])
def test_letters_alone_may_be_a_disguise(chars, written, word):
    assert Restorer(chars).restore(written) == word
    evidence = {"idiot ": 0.9, "stupid ": 0.9, "loser ": 0.9}
    score = Scorer(ToxicityModel(evidence, 0.1, chars)).score(f"so {written} it is")
    assert (score >= 0.5) == (word + " " in evidence)


def test_evidence_equals_brute_force(spark, sf_dir):
    """Every word and stem is counted exactly, in toxic and in clean documents."""
    ship_package(spark)
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    learning = Learning(least_documents=2, least_evidence=0.4)
    model = toxicity.learn(docs.select("doc_id", "text"), labels, learning)
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    pairs = sum(bigram_counts(t) for t in text.values())
    # documents that lie side by side in a batch are joined by a line break, which is a boundary as their ends are
    chars = CharModel.from_counts(np.where(np.arange(len(pairs)) > 0, pairs, 0).reshape(ALPHABET, ALPHABET).astype(float))
    assert np.abs(chars.log_p - model.chars.log_p).max() < 0.05
    first = {}
    for i in sorted(toxic):
        if i in text:
            ws = text[i].encode().split()
            hashed = np.array([xxhash.xxh64_intdigest(w) for w in ws], np.uint64)
            least = int(mix64(windows(hashed, min(5, len(hashed)))).min() >> np.uint64(1)) if ws else -1
            first.setdefault((least, toxic[i]), i)
    counts = {0: Counter(), 1: Counter()}
    restorer = Restorer(model.chars)
    for (_, label), i in first.items():
        found = join_spaced([w.decode() for w in text[i].lower().encode().split()])
        counts[int(label > 0)].update({f for t in {*found} for f in features(restorer.restore(t))})
    enough = max(learning.least_documents, int(learning.least_share * sum(label for _, label in first)))
    bad = {f: n for f, n in counts[1].items() if n >= enough}
    share = {f: n / (n + counts[0][f] + 1.0) for f, n in bad.items()}
    share = {f: e for f, e in share.items() if e >= learning.least_evidence}

    def is_stem(f):
        longer = [bad[g] for g in share if len(g) == len(f) + 1 and g.startswith(f)]
        return len(f) < 8 and len(longer) >= learning.least_branches and max(longer) <= learning.most_in_branch * bad[f]

    want = {f: e for f, e in share.items() if f.endswith(" ") or is_stem(f)}
    assert model.evidence == want and len(want) > 5
