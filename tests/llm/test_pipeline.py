"""The pipeline against plain versions of its stages, and the registered queries on the smallest tables."""

import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from strandline.llm import common, language_id, queries
from tests.llm.test_native_ops import plain_components, plain_simhash
from tests.llm.test_text_ops import POOL, spoken

SF = Path("/root/testdata/sf0.001")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(21)
    common_line = " ".join(r.choices([f"{w}{w}" for w in POOL], k=9)) + " common"
    items = [" ".join(r.choices([f"{w}{k}" for w in POOL for k in "xyz"], k=25)) for _ in range(4)]
    rows = []
    for i in range(260):
        lang = r.choice(["aa", "bb", "cc"])
        text = spoken(r, lang, r.randrange(40, 120))
        kind = i % 13
        if kind == 1:
            text += f"\n  {common_line.upper()} \n" + spoken(r, lang, 12)
        elif kind == 2 and rows:
            text = r.choice([x for x in rows if x[1]])[1]
        elif kind == 3:
            text += f" {r.choice(items)} " + spoken(r, lang, 5)
        elif kind == 4:
            text, lang = r.choice([None, "", "12 34 ?", "\n"]), None
        rows.append((i, text, lang, f"src{i % 3}", len(text or "")))
    return rows, items


def test_pipeline(spark, corpus, tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    if not Path(common.MODEL).exists():
        pytest.skip("no model file")
    rows, items = corpus
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    # language: the model that the stage learns, row by row
    model = language_id.fit(language_id.training_sample(spark.createDataFrame(rows, COLUMNS)))
    kept = {i: t for i, t, *_ in rows if not model.predict(t)[2]}
    assert len(kept) < len(rows) and all(rows[i][1] and any(c.isalpha() for c in rows[i][1]) for i in kept)
    # lines
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i in sorted(kept):
        for k in {key(x) for x in kept[i].split("\n")}:
            held.setdefault(k, []).append(i)
    lines = {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 40 or len(held[key(x)]) < 5 or held[key(x)][-1] == i) for i, t in kept.items()}
    assert lines != kept
    # near duplicates
    ids = sorted(lines)
    roots = plain_components([plain_simhash(lines[i]) for i in ids], 4)
    single = {i: lines[i] for n, i in enumerate(ids) if roots[n] == n}
    assert len(single) < len(lines)
    # benchmark: every planted item is whole, and nothing else comes near
    clean = {i: t for i, t in single.items() if not any(item in t for item in items)}
    assert len(clean) < len(single)
    # tokens
    sp = sentencepiece.SentencePieceProcessor(model_file=common.MODEL)
    want = {i: np.array(sp.encode(t), "<i4") for i, t in clean.items()}
    got = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for i, x in got.items():
        assert (x.n_tokens, x.ids_sha256, x.round_trip) == (len(want[i]), hashlib.sha256(want[i].tobytes()).hexdigest(), True)


def test_stages_return_the_columns_of_documents(spark, corpus, tmp_path):
    rows, items = corpus
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = [*rows[:40], (None, "null id", "aa", None, None), (None, None, None, None, None), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 1, "x") for r in odd], f"{COLUMNS}, lost int, _id string")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, str(tmp_path))
            assert [f.simpleString() for f in out.schema] == [f.simpleString() for f in docs.schema][:5]
            assert out.count() <= some.count()
    near = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert near.where("doc_id = 0").count() == 1 and near.where("doc_id is null").count() == 2


def test_near_duplicates_of_similarity_0_8_go(spark, tmp_path):
    r = random.Random(23)
    grams = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    likeness = lambda a, b: len(grams(a) & grams(b)) / len(grams(a) | grams(b))
    texts, lost, apart = [], set(), 0
    for k in range(30):
        words = [f"{r.choice(POOL)}{k}x{i}" for i in range(200)]
        texts.append(" ".join(words))
        edited = list(words)
        for i in r.sample(range(10, 190, 10), 4 if k % 2 else 9):
            edited[i] = f"new{k}x{i}"
        texts.append(" \n".join(edited).upper())
        if likeness(texts[-2], texts[-1].lower()) >= 0.8:
            lost.add(len(texts) - 1)
            apart += (plain_simhash(texts[-2]) ^ plain_simhash(texts[-1])).bit_count() > 4
    assert len(lost) == 15 and apart > 5
    linked = plain_components([plain_simhash(t) for t in texts], 4)
    texts += [None, "", "a b c", "a b c d"]
    rows = [(i, t, "aa", "src", len(t or "")) for i, t in enumerate(texts)]
    left = {x.doc_id for x in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, COLUMNS), str(tmp_path)).collect()}
    assert left == set(range(len(texts))) - lost - {i for i, c in enumerate(linked) if c != i} - {61}


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted([*queries.QUERIES, "pipeline"]))
def test_registered_queries(spark, name):
    df = {**queries.QUERIES, "pipeline": corpus_pipeline.run}[name](spark, str(SF))
    assert "doc_id" in df.columns and df.count() >= 0


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twins(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, str(SF)).toPandas()[list(want.columns)]
    plain = lambda f: sorted(map(str, f.itertuples(index=False, name=None)))
    assert plain(got) == plain(want)
