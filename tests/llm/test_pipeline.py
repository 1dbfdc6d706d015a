from collections import defaultdict

import corpus_pipeline as pipeline
import __spark_entry__ as entry


def test_stages_on_the_small_tables(spark, small):
    docs = pipeline.table(spark, small, "documents")
    seen = {"": docs}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, small)
        out = spark.createDataFrame(out.collect(), out.schema)
        if name != "pack":
            assert out.columns == docs.columns
        seen[name] = docs = out
    ids = {k: {r.doc_id for r in d.select("doc_id").collect()} for k, d in seen.items()}
    assert len(ids["language"]) >= 0.98 * len(ids[""])
    texts = {r.doc_id: r.text for r in seen["language"].collect()}
    for r in seen["lines"].collect():
        assert r.n_chars == len(r.text) and set(r.text.split("\n")) <= set(texts[r.doc_id].split("\n"))
    # only repeated runs went: every line with ten words or more is still there
    left = {x for r in seen["lines"].collect() for x in r.text.split("\n")}
    assert {x for t in texts.values() for x in t.split("\n") if x.count(" ") >= 9} <= left
    groups = defaultdict(list)
    for r in pipeline.neardup.near_duplicates(seen["lines"]).collect():
        groups[r.component_id].append(r.doc_id)
    assert ids["near_duplicates"] == {min(g) for g in groups.values()}
    leaked = {r.doc_id for r in pipeline.decontam.leaks(
        seen["near_duplicates"], pipeline.table(spark, small, "benchmark")).collect()}
    assert ids["decontaminate"] == ids["near_duplicates"] - leaked and leaked
    assert ids["pack"] == ids["decontaminate"]


def test_texts_of_no_learned_language_go(spark, small):
    import random
    rnd = random.Random(8)
    docs = pipeline.table(spark, small, "documents").select("doc_id", "text", "lang")
    letters = ["".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(rnd.randint(4, 9))) for _ in range(60)]
    odd = [(10**9, "Ελληνικό κείμενο που κανείς δεν έμαθε εδώ", None), (10**9 + 1, " ".join(letters), None),
           (10**9 + 2, "ሀ" * 40, None), (10**9 + 3, "12 34 !", None), (10**9 + 4, None, None)]
    out = pipeline.language(spark, docs.union(spark.createDataFrame(odd, docs.schema)), small)
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    assert not kept & {i for i, _, _ in odd}
    clean = {r.doc_id for r in docs.where("text RLIKE '[A-Za-z]{2,}'").select("doc_id").collect()}
    assert len(clean - kept) <= 0.005 * len(clean), (len(clean - kept), len(clean))


def test_run_is_registered_and_ends_with_the_packed_pieces(spark, small):
    rows = entry.queries()["pipeline"](spark, small).collect()
    ends = defaultdict(int)
    for r in rows:
        ends[r.sequence_id] = max(ends[r.sequence_id], r.offset + r.length)
    assert max(ends.values()) <= 1024 and sum(r.length for r in rows) == sum(ends.values())


def test_an_empty_table_passes_all_stages(spark, small):
    docs = pipeline.table(spark, small, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, small)
        assert docs.count() == 0


def test_extra_columns_pass_through(spark, small):
    from pyspark.sql import functions as F
    names = ["score", "lang_pred", "n_lines", "deleted", "sources", "node", "key", "rank", "kept", "item_id", "_own",
             "_lines", "_sources", "_id", "_mark", "_language", "_Language_Score", "_n_lines", "_Deleted", "_mark_"]
    docs = pipeline.table(spark, small, "documents").withColumns({c: F.concat(F.lit(c), "doc_id") for c in names})
    ids = docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns[-len(names):] == names
        assert docs.where(" OR ".join(f"{c} != concat('{c}', doc_id)" for c in names)).count() == 0
    assert 0 < docs.count() <= ids


def test_near_copies_from_80_of_100_on_go(spark):
    base = [f"b{k}" for k in range(204)]                     # 200 shingles
    # j words more leave 200 of 200 + j shingles
    rows = [(10 * g + k, " ".join(f"{w}g{g}" for w in base + [f"x{k}{j}" for j in range(n)]))
            for g in range(40) for k, n in enumerate([0, 45 if g % 2 else 50])]
    rows += [(10 * g, " ".join(f"{w}g{g}" for w in base)) for g in range(40, 50)]
    rows += [(10 * g + 1, " ".join(f"{w}g{g}" for w in base + [f"x{j}" for j in range(51)])) for g in range(40, 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = sorted(r.doc_id for r in pipeline.near_duplicates(spark, docs, "").collect())
    assert ids == sorted([10 * g for g in range(50)] + [10 * g + 1 for g in range(40, 50)])


def test_rows_go_by_id_and_text(spark, tmp_path):
    """Null ids, repeated rows, and an id with different texts."""
    a, b, c, d, e, leak = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcdel")
    rows = [(None, a), (1, a), (None, b), (None, c), (None, c), (2, d), (2, d), (3, d), (3, e), (4, ""), (4, ""),
            (5, None), (5, None), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in pipeline.near_duplicates(spark, docs, "").collect()]
    want = [(1, a), (None, b), (None, c), (2, d), (3, e), (4, ""), (5, None), (None, None)]
    assert sorted(kept, key=str) == sorted(want, key=str)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(None, leak), (None, a), (6, leak), (6, b), (7, None)], docs.schema)
    kept = [tuple(r) for r in pipeline.decontaminate(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted([(None, a), (6, b), (7, None)], key=str)
