"""The pipeline, stage by stage, on the smallest tables."""

import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from censuskit.llm import bpe, quality
from tests.conftest import SF001
from tests.llm import test_decontam, test_simhash


def test_stages_equal_brute_force(spark):
    read = lambda n: spark.read.parquet(f"{SF001}/{n}.parquet")
    docs = read("documents")
    columns = docs.columns
    model = quality.fit(docs, read("labels"))
    want = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.score >= corpus_pipeline.LEAST_QUALITY}
    steps = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF001).cache()
        assert docs.columns == columns and docs.schema == read("documents").schema
        steps.append({r.doc_id: r for r in docs.collect()})
    quality_, lines_, near, clean = steps
    assert quality_.keys() == good and all(quality_[k] == want[k] for k in good) and 0 < len(good) < len(want)
    # Lines: the share of a source's documents that hold a line.
    by = {}
    for r in quality_.values():
        by.setdefault(r.source, []).append({x.strip(" ") for x in r.text.split("\n")} - {""})
    drop = {s: {x for d in v for x in d if (n := sum(x in e for e in v)) >= corpus_pipeline.LINE_DOCUMENTS and n > corpus_pipeline.LINE_RATIO * len(v)} for s, v in by.items()}
    assert any(drop.values())
    for k, r in quality_.items():
        text = "\n".join(x for x in r.text.split("\n") if x.strip(" ") not in drop[r.source])
        assert lines_[k].text == text and lines_[k].n_chars == len(text)
    groups = test_simhash.brute_groups({k: test_simhash.brute_print(r.text) for k, r in lines_.items()}, 3)
    assert near.keys() == set(groups.values()) and all(near[k] == lines_[k] for k in near)
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    dirty = {d for d, _ in test_decontam.brute([(k, r.text) for k, r in near.items()], items)}
    assert clean.keys() == near.keys() - dirty
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert {r.doc_id for r in last} == clean.keys()
    for r in last:
        ids = library.encode_ordinary(clean[r.doc_id].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(clean[r.doc_id].text.encode()).hexdigest()
    whole = corpus_pipeline.run(spark, SF001).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last))


def test_lines_go_from_small_sources(spark):
    """The share decides from three documents on, in sources of any size."""
    rows, n = [], 0
    # Source, documents, and on how many of them its line stands.
    for source, size, on in (("a", 50, 9), ("b", 50, 5), ("c", 500, 51), ("d", 500, 50), ("e", 20, 3), ("f", 20, 2), ("g", 3, 3), ("h", 2, 2)):
        for i in range(size):
            n += 1
            text = f"own {n}\n" + (f"Share this {source}\n" if i < on else "") + f"\nend {n}"
            rows.append((n, text, "en", source, len(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.without_boilerplate(spark, docs, SF001).collect()}
    drop = {"a", "c", "e", "g"}
    gone = 0
    for k, text, lang, source, _ in rows:
        want = "\n".join(x for x in text.split("\n") if source not in drop or x != f"Share this {source}")
        assert tuple(got[k]) == (k, want, lang, source, len(want))
        gone += want != text
    assert len(got) == len(rows) and gone == 9 + 51 + 3 + 3


def test_stages_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 100_000, "en", None, 500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF001)
            assert now.schema == docs.schema
            assert now.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF001).count() == now.count()
