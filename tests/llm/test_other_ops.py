"""Chat snapshots, neighbour search, components, the pipeline and the registration."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import frame, odd_texts, prose
from parcelscope.llm import chat, hilbert_search
from parcelscope.llm.common import with_ids, without_ids
from parcelscope.llm.components import components


def test_chat_snapshots(spark):
    def conv(i, *texts):
        return [(i, t, "user" if t % 2 == 0 else "assistant", x) for t, x in enumerate(texts)]
    rows = (conv(1, "a", "b") + conv(2, "a", "b", "c") + conv(3, "a") + conv(4, "a", "x") + conv(5, "a", "b", "c")
            + conv(6, None, "") + [(7, None, None, "lost turn"), (7, 0, "user", "q"), (7, 0, "user", "q")]
            + [(None, 0, "user", "a")] + [(8, t, "user", f"m{t}") for t in range(2500)]
            + [(9, t, "user", f"m{t}") for t in range(1500)] + [(10, 0, "user", "z"), (10, 0, "user", "y")])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(9)).withColumn("block", F.lit("b"))
    got = chat.render_conversations(df).collect()
    ids = {r.conv_id for r in got}
    assert ids == {2, 4, 6, 7, 8, 10}  # 1, 3, 9 and the one without id are snapshots, 5 repeats 2
    by = {i: "".join(r.text for r in sorted((r for r in got if r.conv_id == i), key=lambda r: r.part)) for i in ids}
    assert by[2] == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in (("user", "a"), ("assistant", "b"), ("user", "c")))
    assert by[7].startswith("<|im_start|>\nlost turn<|im_end|>") and by[7].count("im_start") == 2
    assert by[8] == "".join(f"<|im_start|>user\nm{t}<|im_end|>\n" for t in range(2500))
    assert by[10].index("y") < by[10].index("z")
    assert {r.n_turns for r in got if r.conv_id == 8} == {2500}
    assert chat.render_conversations(df.limit(0)).count() == 0


def test_chat_blocks_are_bounded_whatever_the_turns(spark):
    """Rows without an id, null turns and repeated turns: no part of more than a block."""
    rows = ([(None, i % 3, "user", f"lost {i:04}") for i in range(2500)] + [(1, None, "user", f"n{i:04}") for i in range(2100)]
            + [(2, 7, "user", f"r{i:04}") for i in range(2100)] + [(3, None, "user", f"n{i:04}") for i in range(1500)]
            + [(4, 5000 * i, "user", f"gap {i}") for i in range(4)])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    by = {}
    for r in sorted(chat.render_conversations(df).collect(), key=lambda r: r.part):
        assert r.text.count(chat.OPEN) <= chat.BLOCK
        by.setdefault((r.conv_id, r.n_turns), []).append(r.text)
    want = {(None, 2500): sorted(r[1:4:2] for r in rows if r[0] is None), (1, 2100): [r[1:4:2] for r in rows if r[0] == 1],
            (2, 2100): [r[1:4:2] for r in rows if r[0] == 2], (4, 4): [r[1:4:2] for r in rows if r[0] == 4]}
    assert {k: "".join(v) for k, v in by.items()} == {
        k: "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for _, t in v) for k, v in want.items()}  # 3 is a snapshot of 1


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = hilbert_search.hilbert_place(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def exact(ids, vecs, query, k=20):
    q = vecs[ids.index(query)]
    s = [(-float(np.dot(np.asarray(v, float), np.asarray(q, float))), i) for i, v in zip(ids, vecs) if i != query]
    return [i for _, i in sorted(s)[:k]]


def test_neighbours_odd_cases(spark):
    r = np.random.default_rng(2)
    vecs = [[round(float(x), 3) for x in r.normal(size=8)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(vecs)]
    rows += [(100 + i, vecs[0]) for i in range(30)]  # copies: ties go to smaller ids
    good = dict(rows)
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] + [1.0] * 7), (260, [None] + [1.0] * 7),
             (280, [float("inf")] + [0.0] * 7), (None, vecs[1]), (300, [1.0, 2.0]), (320, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(5)).withColumn("rank", F.lit("x"))
    got = {}
    for x in hilbert_search.nearest(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x)
    ids, vs = list(good), [np.float32(v) for v in good.values()]
    for q in (0, 20, 40, 100, 120):
        assert [x.vec_id for x in got[q]] == exact(ids, vs, q)
        assert [x.rank for x in got[q]] == list(range(1, 21))
    assert [(x.vec_id, x.score) for x in got[300]] == [(320, 4.0)] and [x.vec_id for x in got[320]] == [300]
    assert set(got) == {0, 20, 40, 100, 120, 300, 320}
    assert hilbert_search.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_neighbour_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {}
    for r in hilbert_search.nearest(df, F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = n = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        want = set(ids[np.argsort(-s, kind="stable")[:20]].tolist())
        hit, n = hit + len(want & found[ids[i]]), n + len(want)
    assert hit / n >= 0.9


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200, 300: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P
    from parcelscope.llm import decontaminate, jaccard_join, quality
    spark.createDataFrame([(1, "never to be found in any of these texts")], "item_id long, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    df = frame(spark, odd_texts())
    docs = df
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name == P.STAGES[-1][0]:
            break
        assert out.columns == df.columns and out.dtypes == df.dtypes
        out.write.parquet(str(tmp_path / name.replace(" ", "-")))
        out = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
        if name == "quality classifier":
            keep = {r.doc_id for r in quality.score_quality(docs).filter("keep = 1").collect()}
            assert {r.doc_id for r in out.collect()} == keep
        elif name == "line dedup":
            assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
            assert out.count() == docs.count()
        elif name == "n-gram Jaccard join":
            of = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(docs).collect()}
            left = [r.doc_id for r in out.collect()]
            assert sorted(x for x in left if x is not None) == sorted({c for i, c in of if i is not None})
        else:
            bench = spark.read.parquet(str(tmp_path / "benchmark.parquet"))
            gone = {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()}
            assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in gone)
        docs = out
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
    for name, stage in P.STAGES[:4]:
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0


def test_pipeline_judges_every_row_by_its_own_text(spark, tmp_path):
    """Rows without an id, and an id with several texts, through both dropping stages."""
    import corpus_pipeline as P
    item = prose(60, 20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    a, b, c, d = (prose(61 + i, 120) for i in range(4))
    near = b.replace(b.split()[60], "changed", 1)
    df = frame(spark, [(5, a), (None, a), (None, a), (None, b), (None, near), (9, c), (9, d), (9, d), (3, d + " end"),
                       (2, None), (None, None)])
    out = P.near_duplicate(spark, df, str(tmp_path)).select("doc_id", "text").collect()
    got = [(r.doc_id, r.text) for r in out if r.text is not None]
    assert len(got) == len(set(got)) == 4
    assert {(5, a), (9, c), (3, d + " end")} <= set(got) and set(got) & {(None, b), (None, near)}
    held = f"{a} {item} {b}"
    df = frame(spark, [(None, held), (None, c), (4, held), (4, d), (5, c)])
    out = P.decontamination(spark, df, str(tmp_path))
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted([("None", c), ("4", d), ("5", c)])


def test_registered_queries():
    import __spark_entry__ as E
    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(E.oracle_sql()) <= names


def test_rows_with_ids(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(-500, 500)] + [(None, "t"), (7, "again")], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 2000, 7)] + [(None,), (-3,)], "doc_id long")
    got = sorted(r.doc_id for r in with_ids(docs, ids).collect())
    assert got == sorted([*range(0, 500, 7), -3, 7])
    rest = [r.doc_id for r in without_ids(docs, ids).collect()]
    assert None in rest and sorted(got + [x for x in rest if x is not None]) == sorted([*range(-500, 500), 7])
    assert with_ids(docs, ids.limit(0)).count() == 0 and with_ids(docs.limit(0), ids).count() == 0


def test_least_work_takes_few_curves_where_they_tell_nothing_and_small_windows_where_they_do():
    r = np.random.default_rng(4)
    n = 100_000
    noise = np.abs(r.integers(0, n, (2000, 24)) - r.integers(0, n, (2000, 24)))
    m, w = hilbert_search.least_work(noise, n, n // 20)
    assert m == hilbert_search.CURVE_CHOICES[0] and np.mean(noise[:, :m].min(axis=1) <= w) >= hilbert_search.RECALL
    near = np.where(r.random((2000, 24)) < 0.6, r.integers(0, 200, (2000, 24)), noise)
    m, w = hilbert_search.least_work(near, n, n // 20)
    assert w <= 300 and np.mean(near[:, :m].min(axis=1) <= w) >= hilbert_search.RECALL


def test_best_of_tied_scores_goes_to_smaller_ids():
    scores = np.array([[1.0, 2.0, 2.0, 2.0, 0.0], [5.0, 5.0, 5.0, 5.0, 5.0]])
    got = hilbert_search._best(np.array([7, 8]), np.array([9, 4, 3, 1, 2]), scores, 2).to_pydict()
    assert got == {"query_id": [7, 7, 8, 8], "id": [1, 3, 1, 2], "score": [2.0, 2.0, 5.0, 5.0]}


def test_neighbours_over_many_small_groups(spark, monkeypatch):
    """Clustered vectors, all queries at one place: groups stay small and recall holds."""
    for name, value in (("BLOCK", 64), ("GROUP", 2), ("CHUNK", 16), ("LEAST_WINDOW", 16)):
        monkeypatch.setattr(hilbert_search, name, value)
    r = np.random.default_rng(9)
    centres = r.normal(size=(20, 12)) * 4
    x = np.concatenate([centres[r.integers(0, 20, 900)] + r.normal(size=(900, 12)) * 0.3,
                        centres[:1] + r.normal(size=(300, 12)) * 0.01])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = lambda i: (i % 20 == 0) | (i >= 1100)
    got = {}
    for row in hilbert_search.nearest(df, asked(F.col("id")), k=10).collect():
        got.setdefault(row.query_id, {})[row.vec_id] = row.score
    hit = total = 0
    for q in [i for i in range(len(x)) if asked(i)]:
        s = x @ x[q]
        s[q] = -np.inf
        want = np.argsort(-s, kind="stable")[:10]
        assert len(got[q]) == 10 and all(abs(v - s[i]) < 1e-9 for i, v in got[q].items())
        hit, total = hit + len(set(want) & set(got[q])), total + 10
    assert hit / total >= 0.9
