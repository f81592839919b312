"""The pipeline's stages and its run against brute force, with null and repeated ids and empty texts."""

import random
from collections import Counter

import pytest

import corpus_pipeline as pipeline

rng = random.Random(5)
made = lambda n: " ".join(rng.choice([f"w{k}" for k in range(400)]) for _ in range(n))
ITEMS = [made(40), made(40), made(40)]
COPY, PASSAGE = made(80), made(30)
ROWS = [
    (1, COPY), (2, COPY), (3, COPY.replace("w", "W")), (4, None), (5, ""), (None, made(50)), (None, COPY), (6, made(60)), (7, made(60)), (7, made(70)),
    (8, f"{made(50)} {PASSAGE} {made(50)}"), (9, f"{made(40)} {PASSAGE} {made(60)}"), (10, f"{made(30)} {ITEMS[0]} {made(30)} {ITEMS[1]}"), (11, f"{made(50)} {ITEMS[2]}"), (14, f"{made(50)} {' '.join(ITEMS[2].split()[5:13])} {made(9)}"), (15, f"{made(50)} {' '.join(ITEMS[2].split()[5:12])} {made(9)}"), (12, made(5)),
]
ROWS += [(20 + k, made(30 + k)) for k in range(8)]


def without_copies(rows):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} - {()} for w in ((t or "").lower().split() for _, t in rows)]
    near = lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    gone = {k for a, (k, _) in enumerate(rows) for b, (other, _) in enumerate(rows) if k is not None and other is not None and other < k and near(a, b)}
    return [r for r in rows if r[0] not in gone]


def without_repeats(rows):
    seen, out = set(), []
    for k, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        w, gone = (t or "").split(), set()
        for i in range(len(w) - 19):
            if tuple(w[i : i + 20]) in seen:
                gone.update(range(i, i + 20))
            seen.add(tuple(w[i : i + 20]))
        out.append((k, " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def uncontaminated(rows):
    windows = {tuple(x.lower().split()[i : i + 8]) for x in ITEMS for i in range(len(x.split()) - 7)}
    texts = [(r, (r[1] or "").lower().split()) for r in rows]
    return [r for r, w in texts if not any(tuple(w[i : i + 8]) in windows for i in range(len(w) - 7))]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    # Further columns, with names that the operators use themselves.
    more = "score double, hits int, items string, kept string, spans int, tell long, t int, carried string, row int, _text string, class int, n_words string"
    spark.createDataFrame([(k, t, "x", 0.0, 1, "a", "b", 2, 3, 4, "c", 5, "d", 6, "e") for k, t in ROWS], f"doc_id long, text string, source string, {more}").coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k != 27), 0) for k in range(20, 28)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_and_run(spark, sf):
    docs = pipeline.table(spark, sf, "documents")
    rows = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    for stage, brute in ((pipeline.keep_one_of_near_copies, without_copies), (pipeline.remove_repeated_passages, without_repeats), (pipeline.drop_contaminated, uncontaminated)):
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes and got.drop("doc_id", "text").distinct().count() == 1 and rows(got) == Counter(brute(ROWS)), stage.__name__
    kept = rows(pipeline.keep_quality(spark, docs, sf))
    assert kept and not kept - Counter(ROWS)
    left = uncontaminated(without_repeats(without_copies(list(kept.elements()))))
    assert Counter(r.doc_id for r in pipeline.run(spark, sf).collect()) == Counter(k for k, _ in left)
