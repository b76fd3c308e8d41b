"""The queries of the llm subpackage against SQL, libraries and brute force."""

import base64
import bisect
import hashlib
import html
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallymark.llm import bpe, fingerprint, forest, lm, mixing
from tallymark.llm.queries import ORACLES, QUERIES
from tallymark.llm.token_counts import START, UNKNOWN_PENALTY, UnigramCounter, log_probabilities
from tools.check_queries import compare, connect


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def found(spark, sf_dir, name, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    problem, _, count = compare(spark, connect(sf_dir), sf_dir, name)
    assert problem is None and count > 0


def test_html_text(spark, sf_dir):
    """The pages have one article each, whose blocks are its headings and paragraphs."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for page_id, row in found(spark, sf_dir, "op2_html_text", "page_id").items():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        want = " ".join(b for b in blocks if b)
        assert (row["text"], row["n_chars"]) == (want, len(want))


def test_jaccard_join(spark, sf_dir, documents):
    sets = {}
    for doc_id, text in documents.items():
        ws = text.encode().split()
        sets[doc_id] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()
    holders = defaultdict(list)
    for doc_id, grams in sets.items():
        for gram in grams:
            holders[gram].append(doc_id)
    common = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    links = Counter()
    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links.update((a, b))
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    rows = found(spark, sf_dir, "op3_jaccard_join")
    assert {d: (r["n_links"], r["class_id"]) for d, r in rows.items()} == {d: (links[d], top(d)) for d in sets}
    assert sum(links.values())


def test_jaccard_join_in_blocks(spark):
    """A group of near copies that is larger than a block: every link is counted once."""
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(f"x{n}" if i == (7 * n) % 300 else w for i, w in enumerate(base)) for n in range(60)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate([*texts, texts[5]])], "doc_id bigint, text string")
    rows = forest.link(docs, forest.ForestSettings(block=8)).collect()
    assert {(r["n_links"], r["class_id"]) for r in rows} == {(60, 0)}
    assert {r["copy_of"] for r in rows if r["doc_id"] == 60} == {5}


def test_forest_prefix_reaches_its_recall():
    settings = forest.ForestSettings()
    assert settings.recall(settings.prefix()) >= settings.target_recall > settings.recall(settings.prefix() + 1)


def test_token_counts(spark, sf_dir, documents):
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    scores = {
        pieces.id_to_piece(i): pieces.get_score(i) for i in range(pieces.get_piece_size())
        if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i) or pieces.is_unused(i))
    }
    # the file holds ranks of merges; a piece of rank r has a probability in proportion to 1 / (r + 1)
    order = sorted(scores.values(), reverse=True)
    share = {piece: 1 / (1 + bisect.bisect_left(order, -s, key=lambda x: -x)) for piece, s in scores.items()}
    total = sum(share.values())
    scores = {piece: math.log(p / total) for piece, p in share.items()}
    longest, unknown = max(map(len, scores)), min(scores.values()) - UNKNOWN_PENALTY
    cache = {}

    def best(word):
        if word not in cache:
            text = START + word
            at = [(0.0, 0)]
            for end in range(1, len(text) + 1):
                ways = [
                    (at[start][0] + scores[text[start:end]], -start, at[start][1] + 1)
                    for start in range(max(0, end - longest), end) if text[start:end] in scores
                ]
                if text[end - 1] not in scores:
                    ways.append((at[end - 1][0] + unknown, 1 - end, at[end - 1][1] + len(text[end - 1].encode())))
                score, _, n = max(ways)
                at.append((score, n))
            cache[word] = at[-1]
        return cache[word]

    for doc_id, row in found(spark, sf_dir, "op4_token_counts").items():
        each = [best(w.decode()) for w in documents[doc_id].encode().split()]
        assert (row["n_words"], row["n_tokens"]) == (len(each), sum(n for _, n in each))
        assert row["token_score"] == pytest.approx(sum(s for s, _ in each))


def test_bpe(spark, sf_dir, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc_id, row in found(spark, sf_dir, "op5_bpe").items():
        ids = library.encode(documents[doc_id], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_language_model(spark, sf_dir, documents):
    def held_out(doc_id):
        return zlib.crc32(str(doc_id).encode()) % 7 == 2

    tokens = {d: [*t.encode().lower().split(), b"\n"] for d, t in documents.items()}
    counts = Counter(w for d, ws in tokens.items() if not held_out(d) for w in ws)
    total, types = sum(counts.values()), len(counts)
    ours = base = 0.0
    for doc_id, row in found(spark, sf_dir, "op7_lm_score").items():
        ws = tokens[doc_id]
        want = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in ws)
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held_out(doc_id), len(ws), total)
        assert row["n_known"] == sum(counts[w] > 0 for w in ws)
        assert row["base_score"] == pytest.approx(want)
        if held_out(doc_id):
            ours, base = ours + row["score"], base + want
    assert ours > base


def test_frequency_filter_errs_only_upwards_and_seldom(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << 63, 40_000, np.uint64)
    counts = rng.geometric(0.2, 20_000)
    settings = lm.LmSettings()
    levels = lm.count_level(counts, settings.step)
    bits = np.frombuffer(lm.set_bits(hashes[:20_000], levels, 1, settings), np.uint8)
    table = lm.FrequencyFilter(bits, np.array([0]), np.array([8 * len(bits)]), 64, 1, settings)
    read = table.counts(hashes)
    assert (read[:20_000] >= lm.level_count(levels, settings.step)).all()
    assert (read[:20_000] > lm.level_count(levels, settings.step)).mean() < 0.05 and (read[20_000:] > 0).mean() < 0.05


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = {d: r for d, r in found(spark, sf_dir, "op8_toxicity").items() if d in labels and r["held_out"]}
    toxic = [r["score"] for d, r in rows.items() if labels[d]]
    clean = [r["score"] for d, r in rows.items() if not labels[d]]
    # about one label in ten of the toxic ones says nothing about the text
    assert sum(s >= 0.5 for s in toxic) >= 0.88 * len(toxic) and sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())


def test_disguised_words_are_restored(spark):
    from tallymark.llm.toxicity import CharModel, Restorer, bigram_counts, join_spaced, ALPHABET

    plain = "you are an idiot and a loser with pathetic stupid trash talk like a moron and a worthless clown " * 50
    restorer = Restorer(CharModel.from_counts(bigram_counts(plain).reshape(ALPHABET, ALPHABET)))
    disguised = {"l0ser": "loser", "1d1ot": "idiot", "i.d.i.o.t": "idiot", "looooser": "loser", "m0r0n!!": "moron",
                 "p@thetic": "pathetic", "trash###": "trash", "$tupid": "stupid", "cl0wn,": "clown", "plain": "plain"}
    assert {w: restorer.restore(w) for w in disguised} == disguised
    assert "idiot" in join_spaced("the i d i o t was".split())
    assert restorer.restore("4785380592391139") == ""


def test_fingerprints(spark, sf_dir, documents):
    order = sorted(documents, reverse=True)
    rows = found(spark, sf_dir, "op9_fingerprint")
    assert len(rows) == len(order)
    for doc_id, following in zip(order, [*order[1:], order[0]]):
        text, row = documents[doc_id], rows[doc_id]
        edited = fingerprint.edit_half(text, documents[following])
        own, changed, other = map(fingerprint.fingerprint, (text, edited, documents[following]))
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (row["fingerprint"], row["edited_fingerprint"]) == (fingerprint.written(own), fingerprint.written(changed))
        assert row["near_edited"] == pytest.approx(fingerprint.likeness(own, changed))
        assert row["near_next"] == pytest.approx(fingerprint.likeness(own, other))
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) > 0.9 * len(rows)


def test_fingerprints_are_homomorphic():
    text, more = "one line of text\nanother line", "a third line\none line of text"
    both = fingerprint.insert(fingerprint.fingerprint(text), more)
    assert fingerprint.written(both) == fingerprint.written(fingerprint.fingerprint(more + "\n" + text))
    assert fingerprint.written(fingerprint.delete(both, more)) == fingerprint.written(fingerprint.fingerprint(text))
    assert fingerprint.written(fingerprint.read(fingerprint.written(both))) == fingerprint.written(both)


def test_pipeline(spark, sf_dir, documents):
    """Every stage's rows against what its operator says of the rows before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stash(stage(spark, docs, sf_dir), "test-pipeline")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    good = {d for d, r in found(spark, sf_dir, "op1_quality").items() if r["kept"]}
    assert set(kept["quality"]) == good
    assert set(kept["toxicity"]) <= good and set(kept["near copies"]) <= set(kept["toxicity"])
    assert max(kept["near copies"].values()) == 1 and max(kept["mixing"].values()) <= 2
    encoded = corpus_pipeline.encode(spark, docs, sf_dir).collect()
    assert Counter(r["doc_id"] for r in encoded) == kept["mixing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in encoded:
        ids = library.encode(documents[r["doc_id"]], add_special_tokens=False).ids
        assert bytes(r["token_ids"]) == struct.pack(f"<{len(ids)}I", *ids)


def test_the_frequency_filter_grows_with_the_corpus(spark, monkeypatch):
    """No n-gram stays out: bits follow insertions over many slices, and every pair seen twice is read as such."""
    import numpy as np
    from tallymark.llm.registry import ship_package

    ship_package(spark)
    monkeypatch.setattr(lm, "SLICE_TOKENS", 1 << 10)
    texts = [f"w{n} v{n} w{n} v{n} x{n}" for n in range(4_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    held = docs["doc_id"] < 0
    model = lm.train(docs.select("text"))
    bits = {r["part"]: r["bits"] for r in model.slices.collect()}
    # w, v and their pair have level 2; ends have level 21
    insertions = 3 * 4_000 * 2 + 21
    assert len(bits) == 32 and 8 * sum(map(len, bits.values())) >= insertions * model.settings.bits_each
    rows = {r["doc_id"]: r["score"] for r in lm.score(docs, held, model).collect()}
    total = 24_000 + 12_001 + 1.0
    p = lambda n: (n + 1) / total
    pair = lambda both, before, n: 0.25 * both / before + 0.75 * p(n)
    ends = lm.level_count(lm.count_level(np.array([4_000]), 1.5), 1.5)[0]
    want = sum(map(math.log10, [
        pair(0, ends, 2), pair(2, 2, 2), pair(0, 2, 2), pair(2, 2, 2), pair(0, 2, 0), p(ends),
    ]))
    near = sum(abs(s - want) < 1e-9 for s in rows.values())
    assert len(rows) == 4_000 and near > 0.85 * len(rows)


def test_heavily_disguised_and_spaced_words_are_evidence():
    from tallymark.llm.toxicity import CharModel, Restorer, Scorer, ToxicityModel, bigram_counts, ALPHABET

    plain = "you are an idiot and a loser with pathetic stupid trash talk an asshole has a class of the people in the house " * 50
    chars = CharModel.from_counts(bigram_counts(plain).reshape(ALPHABET, ALPHABET))
    restorer = Restorer(chars)
    disguised = {"1d10t": "idiot", "l053r": "loser", "7r4$h": "trash", "4$$h0l3": "asshole", "idi" + "o" * 80 + "t": "idiot"}
    assert {w: restorer.restore(w) for w in disguised} == disguised
    for other in ("2019", "3.14159", "455", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08", "1" * 5000):
        assert restorer.restore(other) == ""
    scorer = Scorer(ToxicityModel({w + " ": 0.9 for w in ("idiot", "loser", "asshole", "trash", "ass")}, 0.1, chars))
    for text in ("you are a l o s e r", "i. d. i. o. t.", "so a s s", "y o u a r e a l o s e r", "you a 1 d 1 0 t", "what 7r4$h"):
        assert scorer.score(text) > 0.5, text
    for text in ("you are a class", "a c l a s s of", "1 2 3 4 5 6 7 8", "room 455 in 2019", "a b c d e f g"):
        assert scorer.score(text) < 0.5, text


def test_small_languages_have_their_reference(spark):
    """A language far below half a percent of all words is judged by itself, a NULL one too; its odd text is found."""
    from tallymark.llm import quality
    from tallymark.llm.registry import ship_package

    ship_package(spark)
    english = [f"the cat and the dog of house {n} went to the river and saw a tree in the sun " * 3 for n in range(20)]
    small = "και το σπίτι είναι μεγάλο στη θάλασσα με τον ήλιο που λάμπει για όλους τους ανθρώπους ".split()
    greek = [" ".join(small[(n * 5 + i) % len(small)] + ("" if i % 9 else str(i + n)) for i in range(70)) for n in range(4)]
    bulk = [(n, " ".join(f"{english[n % 20]} {m}" for m in range(n, n + 40)), "en") for n in range(300)]
    odd = " ".join("QX%d" % (i * 7919) for i in range(70))
    rows = [*bulk, *((1000 + n, t, "el") for n, t in enumerate(greek)), *((2000 + n, t, None) for n, t in enumerate(greek)),
            *((3000 + n, t, f"l{n}") for n, t in enumerate(greek)), (4000, odd + " #" * 60, "el"), (4001, odd + " #" * 60, "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    rules = quality.QualityRules(max_repeat_percent=100)
    references = quality.learn_references(docs, rules)
    assert set(references.by_language) == {"en"} and references.others.count() == 6
    judged = quality.judge(docs, references, rules)
    assert judged.columns[:3] == docs.columns and judged.count() == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert all(kept[k] for k in kept if 1000 <= k < 4000)
    # an odd text of a small language is judged by it; one of a language without any reference is kept
    assert not kept[4000] and kept[4001]


def test_html_keeps_the_article_under_body_and_all_of_an_article():
    from tallymark.llm.html_text import main_text

    long = [f"paragraph {n} tells, at some length, of what came to pass in the town that day and of who saw it" for n in range(10)]
    ps = "".join(f"<p>{t}</p>" for t in long)
    for small in ("<table><tr><td>x</td></tr></table>", "<div><div><div>x</div></div></div>"):
        assert main_text(f"<html><body>{ps}{small}</body></html>") == " ".join([*long, "x"])
    links = "<ul><li><a href=a>one link</a></li><li><a href=b>other link</a></li></ul>"
    assert main_text(f"<body>loose start {links}{ps}</body>") == " ".join(["loose start", *long])
    extra = "<blockquote>quoted</blockquote><ul><li>item</li></ul><pre>code</pre><table><tr><td>cell</td></tr></table><figure>shown</figure>"
    page = f"<article><div>{ps}</div>{extra}<div>{ps}</div><section><p>The end.</p></section></article>"
    want = " ".join([*long, "quoted item code cell shown", *long, "The end."])
    assert main_text(f"<body><nav>menu</nav>{page}<div class=footer>foot</div></body>") == want
    assert main_text("<body>" + page.replace("article>", "div>") + "</body>").startswith(want[: -len(" The end.")])




# -- fingerprints and BPE against forms of their own ---------------------------------------------------


def slow_fingerprint(text):
    """The definition in whole numbers of Python: sums over paragraphs, modulo 2 ** 32, and a count."""
    mask = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    exact, near, count = [0] * 64, [0] * 128, 0
    for line in text.split("\n"):
        raw = line.encode("utf-8", "surrogatepass")
        words = raw.split()
        if not words:
            continue
        count += 1
        for i, (lane,) in enumerate(struct.iter_unpack("<I", hashlib.shake_128(raw).digest(256))):
            exact[i] += lane
        hashes = [xxhash.xxh64_intdigest(w) for w in words]
        width = min(3, len(words))
        for i in range(len(words) - width + 1):
            run = hashes[i]
            for h in hashes[i + 1 : i + width]:
                run = mix((run + h) & mask)
            mixed = mix(run)
            near[mixed % 128] += 1 if mixed >> 63 else -1
    lanes = [x % (1 << 32) for x in exact + near]
    return base64.b64encode(struct.pack("<192IQ", *lanes, count)).decode()


def test_fingerprints_equal_their_definition(documents):
    for text in [*list(documents.values())[:40], "", "one", "a b", "a\n\na\n a ", "x y z w\n" * 70]:
        assert fingerprint.written(fingerprint.fingerprint(text)) == slow_fingerprint(text)


def test_likeness_of_long_repetitive_texts():
    """Lanes hold the sums of texts with very many equal lines."""
    line = "the same line of a few words"
    for n, m in ((30_000, 35_000), (40_000, 40_001), (65_536, 131_072)):
        a, b = (fingerprint.fingerprint((line + "\n") * k + "an odd line here") for k in (n, m))
        assert fingerprint.likeness(a, b) > 0.75 and fingerprint.likeness(a, a) == 1.0
    one, other = (fingerprint.fingerprint("\n".join(["first words"] * k + ["second words"] * (65_536 - k))) for k in (0, 65_536))
    assert fingerprint.written(one) != fingerprint.written(other) and fingerprint.likeness(one, other) < 0.2


def test_bpe_decodes_from_ids_and_long_words_encode_alike():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = bpe.load(path), Tokenizer.from_file(path)
    rng = random.Random(8)
    for n in (1, 5, 255, 256, 257, 400):  # both ways to find the lowest rank
        text = "".join(rng.choice("abcdetho") for _ in range(n)) + " the end"
        ids = library.encode(text, add_special_tokens=False).ids
        packed = own.encode(text)
        assert packed == struct.pack(f"<{len(ids)}I", *ids) and own.decode(packed) == library.decode(ids, skip_special_tokens=False)
    assert own.decode(struct.pack("<3I", 300, 5, 77)) == library.decode([300, 5, 77], skip_special_tokens=False)


def test_mixing_buckets_follow_the_table(spark, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("a b c").alias("text"))
    whole = sorted(map(tuple, mixing.mix(docs, F.lit(3)).select("doc_id", "taken").collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    assert sorted(map(tuple, mixing.mix(docs, F.lit(3)).select("doc_id", "taken").collect())) == whole


def test_token_counts_are_near_those_of_the_encoder(documents):
    """Budgets need counts like the vocabulary's own: within a tenth over all texts, and common words are one token."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    counter, own = UnigramCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)
    found = Counter(w for t in documents.values() for w in t.encode().split())
    counter.learn(found)
    ours = sum(counter.counts[w] * n for w, n in found.items())
    theirs = sum(len(own.encode(w.decode())) * n for w, n in found.items())
    assert abs(ours - theirs) < 0.1 * theirs
    common = [b"the", b"running", b"government", b"understanding", b"computer"]
    counter.learn(common)
    assert [counter.counts[w] for w in common] == [1] * 5
    counter.learn([b"internationalization"])
    assert counter.counts[b"internationalization"] == 2


def test_scores_that_are_no_ranks_stay():
    assert log_probabilities([-1.5, -2.0]) == [-1.5, -2.0]
    zipf = log_probabilities([0.0, -1.0, -2.0, -2.0])
    assert sum(map(math.exp, zipf)) == pytest.approx(1) and zipf[0] > zipf[1] > zipf[2] == zipf[3]
