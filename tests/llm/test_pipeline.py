"""The pipeline against brute force on planted documents, and its stage contract."""

import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from strata.llm import decontamination as D
from strata.llm import quality_rules as Q
from tests.llm.test_simhash import brute_components, brute_fingerprint

STAGE_NAMES = ["quality_rules", "quality_classifier", "simhash_near_dedup", "decontamination", "packing"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean, near-copied, leaking, short, repetitive and toxic documents."""
    rng = random.Random(11)
    vocab = [f"{a}{b}" for a in "ban den fir gol hum jat kel mor pas ril sut vor".split()
             for b in "a e i o u an en in on un ar er".split()]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(30))) for i in range(6)]
    docs, labels, kind = [], [], {}

    def add(words, what, quality=1, toxic=0):
        i = len(docs) * 3
        docs.append((i, " ".join(words), "en", f"src{i % 5}", 0))
        kind[i] = what
        if i % 2 == 0:
            labels.append((i, quality, toxic))
        return i

    clean = lambda n=120: [rng.choice(vocab) for _ in range(n)]
    for _ in range(220):
        base = clean(rng.randint(80, 200))
        add(base, "clean")
    for _ in range(15):
        base = clean(400)
        add(base, "clean")
        add(base, "copy")
    for _ in range(60):
        add(clean(60) + ["nasty", "vile"] + clean(60), "toxic", 1, 1)
    for k in range(10):
        words = clean()
        words[20:20] = items[k % 6][1].split()
        add(words, "leak")
    for _ in range(5):
        add(clean(20), "short")
        add(clean(3) * 40, "repetitive", 0)
    folder = str(tmp_path_factory.mktemp("corpus"))
    n_chars = [(i, t, lang, src, len(t)) for i, t, lang, src, _ in docs]
    spark.createDataFrame(n_chars, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, n_chars, dict(items), kind


def test_stages(spark, corpus):
    folder, rows, items, kind = corpus
    assert [n for n, _ in P.STAGES] == STAGE_NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept, text = [{r[0] for r in rows}], {r[0]: r[1] for r in rows}
    for name, step in P.STAGES[:-1]:
        docs = P.stage(step(spark, docs, folder), name)
        assert docs.columns == columns, name
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        assert docs.count() == len(kept[-1]) and kept[-1] <= kept[-2]
    # quality rules: with so few labels only the base rules reject
    gone = kept[0] - kept[1]
    assert gone == {i for i, k in kind.items() if k in ("short", "repetitive")}
    assert all(len(text[i].split()) >= Q.MIN_WORDS for i in kept[1])
    # classifier
    gone = kept[1] - kept[2]
    toxic = {i for i, k in kind.items() if k == "toxic"}
    assert len(gone & toxic) >= 0.95 * len(toxic) and len(gone - toxic) <= 3
    # near-duplicates: the smallest id of each brute-force component
    ids = sorted(kept[2])
    comp = brute_components([brute_fingerprint(text[i]) for i in ids])
    smallest = {}
    for i, c in zip(ids, comp):
        smallest[c] = min(smallest.get(c, i), i)
    assert kept[3] == set(smallest.values())
    assert len(kept[2] - kept[3]) >= 10
    # decontamination: brute-force edit distance of every item to every document
    held = {i for i in kept[3] if any(
        D.least_distance(D.words_of(t), D.words_of(text[i]))[0] <= D.allowed_edits(len(D.words_of(t)))
        for t in items.values())}
    assert kept[3] - kept[4] == held and held
    # packing: every id of every kept document once
    pieces = defaultdict(bytes)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in sorted(P.STAGES[-1][1](spark, docs, folder).collect(), key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] * 4 == len(pieces[r["doc_id"]])
        pieces[r["doc_id"]] += bytes(r["ids"])
    assert set(pieces) == kept[4]
    for i in kept[4]:
        want = b"".join(x.to_bytes(4, "little") for x in lib.encode(text[i], add_special_tokens=False).ids + [1])
        assert zlib.crc32(pieces[i]) == zlib.crc32(want)


def test_run_on_empty_tables(spark, corpus, scratch):
    folder = corpus[0]
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{scratch}/{t}.parquet")
    assert P.run(spark, scratch).count() == 0


def test_a_worker_holds_what_one_operator_needs():
    """Workers serve all stages: a stage must not hold the tables of the stages before it."""
    import gc
    import weakref

    import public_tokenizers

    from strata.llm import common, decontamination, token_counts, tokens
    path = public_tokenizers.path("word_bpe_49k.json")
    made = [lambda: tokens.encoder(path, "word", 1 << 20), lambda: decontamination.index_of(((1, "a b c d e f"),), 1),
            lambda: token_counts.counter(public_tokenizers.path("byte_bpe_50k.json"))]
    for make, other in zip(made, made[1:] + made[:1]):
        first = make()
        assert make() is first
        held = weakref.ref(first)
        del first
        other()
        gc.collect()
        assert held() is None
    common.release()
    assert not common._KEPT
