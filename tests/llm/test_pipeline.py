"""The pipeline against its stages recomputed in plain Python, and on the messy table."""

import re

import corpus_pipeline
from revue.llm import langid, mixing, near_dedup, stages
from revue.llm.queries import language_model
from tests.llm.conftest import SMALL
from tests.llm.test_texts import brute_matches, levenshtein, shingles_of, words_of


def test_run_equals_stage_by_stage_brute_force(spark, small):
    docs = {r.doc_id: r for r in small.collect()}
    verdict = {r.doc_id: r.rejected for r in langid.identify(small, language_model(small)).collect()}
    assert all(re.search(r"[^\W\d_]", docs[d].text or "") is None or not r for d, r in verdict.items())
    left = sorted(d for d in docs if not verdict[d])

    seqs = {d: shingles_of(words_of(docs[d].text)) for d in left}
    comp = {d: d for d in left}
    for _ in range(3):
        for a in left:
            for b in left:
                x, y = seqs[a], seqs[b]
                longer = max(len(x), len(y))
                if a < b and comp[a] != comp[b] and len(set(x) & set(y)) >= 0.3 * min(len(set(x)), len(set(y))) > 0 and \
                        levenshtein(x, y) <= 0.2 * longer + 1e-9:
                    comp[a] = comp[b] = min(comp[a], comp[b])
    left = [d for d in left if comp[d] == d]

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    near = [(d, docs[d].text) for d in left
            if any(set(shingles_of(words_of(t))) & set(shingles_of(words_of(docs[d].text))) for _, t in items)]
    leaks = {d for d, _ in brute_matches(near, items)}
    left = [d for d in left if d not in leaks]

    kept = spark.createDataFrame([docs[d] for d in left], small.schema)
    reps = {r.doc_id: r.reps for r in mixing.mix(kept, stages.MIX_CYCLE, stages.MIX_SHARE, stages.MIX_EPOCHS).collect()}
    got = corpus_pipeline.run(spark, SMALL).toPandas()
    assert got.groupby("doc_id").size().to_dict() == {d: n for d, n in reps.items() if n}
    sizes = got.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_stages_keep_columns_and_clean_documents(spark, messy, empty):
    docs = messy
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == messy.columns, name
        assert stage(spark, empty, SMALL).count() == 0, name
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SMALL).count() == 0
    kept = stages.near_duplicates(spark, messy, SMALL)
    dropped = near_dedup.near_dedup(messy).where("not kept").count()
    assert kept.count() == messy.count() - dropped


def test_written_shards_hold_the_mix_with_its_repeats(spark, messy, small):
    from collections import Counter

    from revue.conf import scratch_path
    from revue.llm import sharding
    docs = small.limit(60).unionByName(small.limit(60)).unionByName(small.where("doc_id < 3").selectExpr(
        "cast(null as long) as doc_id", "text", "lang", "source", "n_chars"))
    mixed = mixing.mixed_rows(docs, stages.MIX_CYCLE, stages.MIX_SHARE, stages.MIX_EPOCHS)
    for df, shards in ((mixed, 5), (messy.drop("shard", "slot", "copy"), 3)):
        path = scratch_path(spark, "shards")
        sharding.write_shards(df, path, shards)
        back = spark.read.parquet(path)
        assert set(back.columns) == {*df.columns, "shard", "slot", "copy"}
        assert Counter(map(tuple, back.select(df.columns).collect())) == Counter(map(tuple, df.collect()))
        places = [(r["shard"], r["slot"]) for r in back.collect()]
        assert len(set(places)) == len(places)
        plan = sharding.interleave(df, shards)
        assert Counter((r["doc_id"], r["source"], r["shard"], r["slot"]) for r in plan.collect()) == Counter(
            (r["doc_id"], r["source"], r["shard"], r["slot"]) for r in back.collect())


def test_sources_beyond_the_broadcast_ones_are_mixed_alike(spark, small, monkeypatch):
    want = sorted(map(repr, mixing.mixed_rows(small, [5.0, 2.0, 1.0], 1.5).collect()))
    monkeypatch.setattr(mixing, "LARGE_SOURCES", 3)
    assert sorted(map(repr, mixing.mixed_rows(small, [5.0, 2.0, 1.0], 1.5).collect())) == want
