"""The jobs end to end: run, compare, hand on, and run again."""

import hashlib
import math
import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellshift.operators import compare, embed, quality, specs as sp
from cellshift.plans import jobs
from cellshift.plans.layout import of_runs
from cellshift.session import shared_path
from tests import fixtures as fx

DIM = 8


def code(gene):
    return int(hashlib.md5(gene.encode()).hexdigest()[:6], 16) * 7919


def vector(matrix, cell):
    return [
        sum(
            math.log1p(v) * ((code(g) + d * embed.STEP) % embed.MODULUS / embed.MODULUS - 0.5)
            for (c, g), v in matrix.items()
            if c == cell
        )
        for d in range(DIM)
    ]


def cosine_distance(a, b):
    norm = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return 1 - max(-1.0, min(1.0, sum(x * y for x, y in zip(a, b)) / max(norm, 1e-8)))


def median(values):
    s = sorted(values)
    return (s[(len(s) - 1) // 2] + s[len(s) // 2]) / 2 if s else None


def expected_summaries(specs):
    base = fx.values()
    cells = [f"cell_{i:06d}" for i in range(12)]
    before = {c: vector(base, c) for c in cells}
    out = []
    for spec in specs:
        after = fx.perturbed(spec)
        d = {c: cosine_distance(vector(after, c), before[c]) for c in cells}
        target = [d[c] for c in cells if fx.in_cohort(c, spec[5] or None, spec[6] or None)]
        values = list(d.values())
        mean = sum(values) / 12
        std = math.sqrt(sum((v - mean) ** 2 for v in values) / 12)
        out.append(
            (12, len(target), mean, median(values), std, min(values), max(values),
             sum(target) / len(target) if target else None, median(target))
        )
    return out


COLUMNS = (
    "n_cells", "n_target_cells", "mean_distance", "median_distance", "std_distance", "min_distance",
    "max_distance", "mean_distance_target_subset", "median_distance_target_subset",
)


def assert_summaries(df, specs):
    got = [tuple(r[c] for c in COLUMNS) for r in df.orderBy("position").collect()]
    assert len(got) == len(specs)
    for mine, wanted in zip(got, expected_summaries(specs)):
        assert mine == pytest.approx(wanted, abs=2e-6, nan_ok=True)


@pytest.fixture(scope="module")
def dataset(spark):
    return jobs.Dataset("data/small", "print-1", fx.cells(spark), fx.genes(spark), fx.expression(spark))


@pytest.fixture(scope="module")
def root(spark):
    return shared_path(spark, "jobs")


def test_types_run_once_and_are_compared(spark, dataset, root):
    specs = fx.specs(spark)
    first = jobs.run_types(spark, root, dataset, specs, "config-1", DIM)
    assert {r.perturbation_type: (r.n_experiments, r.cache_hit) for r in first.collect()} == {
        "gene_knockout": (2, False),
        "gene_overexpression": (4, False),
        "gene_activation": (4, False),
    }
    again = jobs.run_types(spark, root, dataset, specs, "config-1", DIM)
    assert [r.cache_hit for r in again.collect()] == [True] * 3
    other = jobs.typed_work(dataset, specs, "config-2", "mock_foundation_model_1")
    assert not {r.run_id for r in other.collect()} & {r.run_id for r in first.collect()}

    compared = jobs.compare_incrementally(spark, root, dataset, first, DIM)
    assert [r.cache_hit for r in compared.collect()] == [False] * 3
    assert_summaries(spark.read.parquet(f"{root}/silver/summaries"), fx.SPECS)
    again = jobs.compare_incrementally(spark, root, dataset, first, DIM)
    assert [r.cache_hit for r in again.collect()] == [True] * 3
    assert_summaries(spark.read.parquet(f"{root}/silver/summaries"), fx.SPECS)


def test_gold_has_every_experiment(spark, root):
    records = spark.read.json(f"{root}/gold/ui/perturbation_records").select(
        "run_id", F.explode("experiments").alias("e"), "run_metadata"
    )
    assert records.count() == len(fx.SPECS)
    row = records.where("e.gene = 'GENE0003'").first()
    assert row.e.experiment_id == "exp_0000"
    assert row.e.n_target_cells == 6
    assert row.e.involved_cell_types == ["B_cell", "T_cell"]
    assert row.run_metadata.n_experiments == 4
    cards = spark.read.json(f"{root}/gold/ui/comparison_cards").select(F.explode("experiments").alias("e"))
    assert cards.count() == len(fx.SPECS)
    assert cards.where("e.mean_distance IS NULL").count() == 0
    silver = spark.read.parquet(f"{root}/silver/embeddings")
    vectors = jobs.handed_on(spark, root, "embeddings", silver.schema)
    assert vectors.select(*silver.columns).exceptAll(silver).count() == 0 and vectors.count() == silver.count()
    assert jobs.distance_bundle(spark, root).count() == silver.count()
    one = spark.read.parquet(f"{root}/silver/runs").select("run_id").limit(1)
    assert jobs.distance_bundle(spark, root, one).count() == of_runs(silver, one).count()
    base = jobs.handed_on(spark, root, "baseline", "cell_id string, embedding array<float>")
    assert base.count() == 12 and base.select("source").distinct().count() == 1


def test_records_name_folders_that_hold_their_rows(spark, root):
    for row in spark.read.parquet(f"{root}/silver/experiments").where("n_changed > 0").collect():
        stored_rows = spark.read.parquet(f"{root}/{row.output_embeddings}")
        assert stored_rows.where(F.col("experiment_id") == row.experiment_id).count() == row.n_changed
    for row in spark.read.parquet(f"{root}/silver/summaries").select("distance_file").distinct().collect():
        assert spark.read.parquet(f"{root}/{row.distance_file}").count() > 0


def test_headers_tell_where_results_come_from(spark, root):
    for row in spark.read.parquet(f"{root}/silver/runs").collect():
        assert row.perturbation_types_defined == [row.run_id.split("__")[0]]  # what the run declares
        assert row.run_created_at_utc.endswith("+00:00") and row.dataset == "data/small"
    for row in spark.read.parquet(f"{root}/silver/comparisons").collect():
        assert spark.read.parquet(f"{root}/{row.source_run_path}").count() == 1
        assert spark.read.parquet(row.baseline_path).count() == 12 and row.computed_at_utc.endswith("+00:00")


def _files(folder):
    path = folder.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def test_a_reused_run_writes_nothing(spark, dataset, root):
    before = _files(root)
    runs = jobs.run_types(spark, root, dataset, fx.specs(spark), "config-1", DIM)
    jobs.compare_incrementally(spark, root, dataset, runs, DIM)
    assert _files(root) == before


def test_jobs_delete_their_own_tables(spark, dataset):
    scratch = spark.conf.get("spark.checkpoint.dir") + "/cellshift"
    root = shared_path(spark, "tidy")
    runs = jobs.run_types(spark, root, dataset, fx.specs(spark), "config-1", DIM)
    compared = jobs.compare_incrementally(spark, root, dataset, runs, DIM)
    left = os.listdir(scratch.removeprefix("file:"))
    assert not [name for name in left if name.startswith(("run_experiments", "compare_runs", "export_"))]
    assert runs.count() == compared.count() == 3  # what the jobs return is still there


def row_measures(genes, values):
    """Depends on every gene of a cell, and on which they are."""
    out = [[v.sum(), len(v), sum(int(g[-1]) * x for g, x in zip(gs, v)), 1.0] for gs, v in zip(genes, values)]
    return np.array(out, dtype=float).reshape(len(genes), 4)


def test_a_users_model_sees_whole_perturbed_cells(spark, dataset, monkeypatch):
    monkeypatch.setattr(embed, "CHANGES", 3)  # several chunks of experiments a cell
    root, specs = shared_path(spark, "user-model"), fx.specs(spark)
    chosen = embed.UserModel("row_measures", "1", row_measures)
    runs = jobs.run_types(spark, root, dataset, specs, "config-1", 4, chosen)
    built_in = jobs.typed_work(dataset, specs, "config-1", None)
    other = jobs.typed_work(dataset, specs, "config-1", embed.UserModel("row_measures", "2", row_measures))
    ids = [{r.run_id for r in df.collect()} for df in (runs, built_in, other)]
    assert not (ids[0] & ids[1] or ids[0] & ids[2])
    places = {r.run_id: r.perturbation_type for r in runs.collect()}
    positions = defaultdict(list)
    for i, spec in enumerate(fx.SPECS):
        positions[spec[0].strip().lower()].append(i)
    base, n = fx.values(), 0
    for r in spark.read.parquet(f"{root}/silver/embeddings").collect():
        spec = fx.SPECS[positions[places[r.run_id]][int(r.experiment_id[-4:])]]
        after = fx.perturbed(spec)
        row = {g: v for (c, g), v in after.items() if c == r.cell_id}
        assert row != {g: v for (c, g), v in base.items() if c == r.cell_id}
        assert list(r.embedding) == pytest.approx([sum(row.values()), len(row), sum(int(g[-1]) * v for g, v in row.items()), 1.0])
        n += 1
    assert n > 0
    jobs.compare_incrementally(spark, root, dataset, runs, 4, chosen)
    assert spark.read.parquet(f"{root}/silver/summaries").where("mean_distance IS NULL").count() == 0


def test_a_model_of_the_wrong_shape_stops_the_job(spark, dataset):
    wrong = embed.UserModel("wrong", "1", lambda genes, values: np.zeros((len(genes), 3)))
    with pytest.raises(Exception, match="model returned shape"):
        jobs.run_types(spark, shared_path(spark, "wrong"), dataset, fx.specs(spark), "c", 4, wrong)


def test_runs_without_a_name_are_refused(spark, root):
    nameless = spark.createDataFrame([("",)], "run_id string")
    with pytest.raises(Exception, match="a run has no name"):
        of_runs(spark.read.parquet(f"{root}/silver/runs"), nameless).count()


def test_vectors_of_all_cells_of_one_experiment(spark, dataset, root):
    changed = spark.read.parquet(f"{root}/silver/embeddings")
    run = changed.where("run_id LIKE 'gene_knockout%'").first().run_id
    base = jobs.baseline(spark, root, dataset, DIM, None)
    got = jobs.embeddings_of([(run, "exp_0000")], changed, base).collect()
    assert len(got) == 12
    after = fx.perturbed(fx.SPECS[0])
    for r in got:
        assert list(r.embedding) == pytest.approx(vector(after, r.cell_id), abs=1e-5)


def test_foreign_baseline_compares_every_cell(spark, dataset, root):
    path = shared_path(spark, "other-baseline")
    base = jobs.baseline(spark, root, dataset, DIM, None)
    base.select("cell_id", F.reverse("embedding").alias("embedding")).write.parquet(path)
    runs = spark.read.parquet(f"{root}/silver/runs").select("run_id", F.lit("t").alias("comparison_token"))
    source = jobs.compare_runs(spark, root, dataset, runs, DIM, baseline_path=path)
    assert source == path
    summaries = spark.read.parquet(f"{root}/silver/summaries")
    assert {r.n_cells for r in summaries.collect()} == {12}
    knockout = fx.perturbed(fx.SPECS[0])
    wanted = [
        cosine_distance(vector(knockout, c), vector(fx.values(), c)[::-1])
        for c in (f"cell_{i:06d}" for i in range(12))
    ]
    row = summaries.where("position = 0").first()
    mean = sum(wanted) / 12
    assert row.mean_distance == pytest.approx(mean, abs=1e-5)
    assert row.median_distance == pytest.approx(median(wanted), abs=1e-5)
    assert row.min_distance == pytest.approx(min(wanted), abs=1e-5)
    assert row.max_distance == pytest.approx(max(wanted), abs=1e-5)
    assert row.std_distance == pytest.approx(
        math.sqrt(sum((w - mean) ** 2 for w in wanted) / 12), abs=1e-5
    )
    assert row.median_distance_target_subset == pytest.approx(median(wanted), abs=1e-5)


def test_missing_baseline_falls_back_and_says_so(spark, dataset, root):
    runs = spark.read.parquet(f"{root}/silver/runs").select("run_id", F.lit("t").alias("comparison_token"))
    source = jobs.compare_runs(spark, root, dataset, runs, DIM, baseline_path=root + "/nowhere")
    assert source == "computed_from_input"
    header = spark.read.parquet(f"{root}/silver/comparisons").first()
    assert header.baseline_source == "computed_from_input"
    assert_summaries(spark.read.parquet(f"{root}/silver/summaries"), fx.SPECS)


def test_batches_run_and_skip(spark, dataset):
    root = shared_path(spark, "batch-jobs")
    specs = fx.specs(spark)
    keys = spark.createDataFrame([("batch_0000",), ("batch_0002",), ("batch_0007",)], "batch_key string")
    wanted = sp.partition_grid(keys)
    first = jobs.run_batches(spark, root, dataset, specs, wanted, 4, "config-1", DIM)
    status = {(r.batch_key, r.perturbation_type): r.status for r in first.collect()}
    assert status[("batch_0000", "gene_knockout")] == "run"
    assert status[("batch_0002", "gene_knockout")] == "skipped_no_matching_partition_perturbation_type"
    assert status[("batch_0007", "gene_activation")] == "skipped_missing_batch"
    compared = jobs.compare_incrementally(spark, root, dataset, first, DIM)
    by_status = {r.comparison_status for r in compared.where("skipped").collect()}
    assert by_status == {"skipped_upstream_batch"}
    chosen = [s for i, s in enumerate(fx.SPECS) if i // 4 in (0, 2)]
    assert_summaries(spark.read.parquet(f"{root}/silver/summaries"), chosen)
    # Batches of three: only a partition with the very same experiments is reused.
    resized = jobs.batch_work(dataset, specs, wanted, 3, "config-1", "mock_foundation_model_1")
    runs = {(r.batch_key, r.perturbation_type): r.run_id for r in resized.collect()}
    done = {(r.batch_key, r.perturbation_type): r.run_id for r in first.collect()}
    assert runs[("batch_0000", "gene_overexpression")] == done[("batch_0000", "gene_overexpression")]
    assert runs[("batch_0000", "gene_knockout")] != done[("batch_0000", "gene_knockout")]


def test_invalid_specs_stop_before_any_write(spark, dataset):
    root = shared_path(spark, "invalid")
    bad = fx.specs(spark, [*fx.SPECS, ("gene_knockout", "GENE9999", None, None, None, None, None)])
    with pytest.raises(ValueError, match="no valid gene"):
        jobs.run_types(spark, root, dataset, bad, "config-1", DIM)
    assert not jobs.is_stored(spark, root + "/silver/embeddings", "run_id string")


def test_incomplete_runs_are_not_compared(spark, dataset, root):
    absent = spark.createDataFrame([("gene_knockout__none", "t")], "run_id string, comparison_token string")
    with pytest.raises(ValueError, match="runs without a manifest"):
        jobs.compare_runs(spark, root, dataset, absent, DIM)


def broken_copy(spark, root, vectors):
    """A finished root with other stored vectors."""
    copy = shared_path(spark, "broken")
    for name in ("runs", "experiments"):
        df = spark.read.parquet(f"{root}/silver/{name}")
        df.write.partitionBy("run_id").parquet(f"{copy}/silver/{name}")
    if vectors is not None:
        vectors.write.partitionBy("run_id").parquet(f"{copy}/silver/embeddings")
    return copy


@pytest.mark.parametrize("loss", ["all", "one", "unknown_cell", "width"])
def test_lost_or_wrong_vectors_are_not_compared(spark, dataset, root, loss):
    whole = spark.read.parquet(f"{root}/silver/embeddings")
    first = whole.orderBy("run_id", "experiment_id", "cell_id").first()
    hit = (F.col("run_id") == first.run_id) & (F.col("experiment_id") == first.experiment_id)
    hit &= F.col("cell_id") == first.cell_id
    vectors = {
        "all": None,
        "one": whole.where(~hit),
        "unknown_cell": whole.withColumn("cell_id", F.when(hit, "cell_none").otherwise(F.col("cell_id"))),
        "width": whole.withColumn("embedding", F.when(hit, F.slice("embedding", 1, 3)).otherwise(F.col("embedding"))),
    }[loss]
    copy = broken_copy(spark, root, vectors)
    runs = spark.read.parquet(f"{copy}/silver/runs").select("run_id", F.lit("t").alias("comparison_token"))
    with pytest.raises(Exception, match="stored vectors are not those|expected vectors of width"):
        jobs.compare_runs(spark, copy, dataset, runs, DIM)
    assert not jobs.is_stored(spark, copy + "/silver/comparisons", "run_id string")


def test_checks_pass_on_stored_runs(spark, root):
    manifest = spark.read.parquet(f"{root}/silver/experiments")
    vectors = spark.read.parquet(f"{root}/silver/embeddings")
    assert manifest.where("n_changed = 0").count() > 0
    assert manifest.agg(F.sum("n_changed")).first()[0] == vectors.count()
    row = quality.embedding_shape_check(manifest, vectors, DIM).first()
    assert row.passed and row.failures_count == 0
    lost = quality.embedding_shape_check(manifest, vectors.limit(0), DIM).first()
    assert lost.failures_count == manifest.where("n_changed > 0").count()
    absent = manifest.select("run_id").distinct().unionByName(spark.createDataFrame([("never_run",)], "run_id string"))
    row = quality.embedding_shape_check(manifest, vectors, DIM, absent).first()
    assert not row.passed and row.failures == ["never_run: missing manifest"] and row.n_runs == absent.count()


def test_only_the_runs_asked_for_are_read(spark, root):
    path = shared_path(spark, "wanted")
    spark.read.parquet(f"{root}/silver/runs").select("run_id").limit(1).write.parquet(path)
    rows = of_runs(spark.read.parquet(f"{root}/silver/embeddings"), spark.read.parquet(path))
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.select("run_id").distinct().count() <= 1


def test_unknown_model_is_refused(spark, dataset):
    with pytest.raises(ValueError, match="unsupported model"):
        jobs.run_types(spark, "/nowhere", dataset, fx.specs(spark), "c", DIM, "other_model")


def floats(df):
    """Each vector's values to the last bit."""
    return {(r.run_id, r.experiment_id, r.cell_id): list(r.embedding) for r in df.collect()}


def test_vectors_kept_as_entries_are_the_same(spark, dataset, root, monkeypatch):
    monkeypatch.setattr(compare, "TOGETHER", 2)  # several lists a cell
    whole = floats(spark.read.parquet(f"{root}/silver/embeddings"))
    kept = shared_path(spark, "kept")
    runs = jobs.run_types(spark, kept, dataset, fx.specs(spark), "config-1", DIM, as_entries=True)
    rows = spark.read.parquet(f"{kept}/silver/embeddings")
    assert rows.where("embedding IS NOT NULL OR es IS NULL").isEmpty() and rows.count() == len(whole)
    like = "run_id string, experiment_id string, cell_id string, embedding array<float>"
    assert floats(jobs.handed_on(spark, kept, "embeddings", like)) == whole

    jobs.compare_incrementally(spark, kept, dataset, runs, DIM)
    assert_summaries(spark.read.parquet(f"{kept}/silver/summaries"), fx.SPECS)
    columns = ["run_id", "experiment_id", "cell_id", "distance", "is_target"]
    base = jobs.baseline(spark, root, dataset, DIM, None)
    path = shared_path(spark, "turned")
    base.select("cell_id", F.reverse("embedding").alias("embedding")).write.parquet(path)
    named = runs.select("run_id", F.lit("t").alias("comparison_token"))
    for other in (None, path):
        found = []
        for at in (root, kept):
            jobs.compare_runs(spark, at, dataset, named, DIM, baseline_path=other)
            found.append(sorted(map(tuple, spark.read.parquet(f"{at}/silver/distances").select(*columns).collect())))
        assert len(found[0]) == len(whole) and found[0] == found[1]

    run, experiment, cell = next(iter(whole))
    got = {r.cell_id: list(r.embedding) for r in jobs.embeddings_of([(run, experiment)], rows, base).collect()}
    assert len(got) == 12 and got[cell] == whole[run, experiment, cell]


def test_entries_move_the_baseline_of_their_own_run(spark, dataset):
    """Compared with another model's baseline, vectors are those of the model that ran, kept either way."""
    found = []
    for as_entries in (False, True):
        root = shared_path(spark, "other-model")
        specs = fx.specs(spark, fx.SPECS[:3])
        runs = jobs.run_types(spark, root, dataset, specs, "c", DIM, "mock_foundation_model_2", as_entries=as_entries)
        jobs.compare_incrementally(spark, root, dataset, runs, DIM, "mock_foundation_model_3")
        rows = spark.read.parquet(f"{root}/silver/distances").select("run_id", "experiment_id", "cell_id", "distance")
        found.append(sorted(map(tuple, rows.collect())))
    assert found[0] and found[0] == found[1]


def test_lost_entries_are_not_compared(spark, dataset):
    root, specs = shared_path(spark, "lost-entries"), fx.specs(spark, fx.SPECS[:1])
    jobs.run_types(spark, root, dataset, specs, "c", DIM, as_entries=True)
    rows = spark.read.parquet(f"{root}/silver/embeddings")
    none = F.lit(None).cast(embed.ENTRIES)
    for broken in (rows.where("cell_id <> 'cell_000001'"), rows.withColumn("es", F.when(F.col("cell_id") != "cell_000001", F.col("es")).otherwise(none))):
        named = spark.read.parquet(f"{root}/silver/runs").select("run_id", F.lit("t").alias("comparison_token"))
        with pytest.raises(Exception, match="stored vectors are not those|expected vectors of width 8, got none"):
            jobs.compare_runs(spark, broken_copy(spark, root, broken), dataset, named, DIM)
    with pytest.raises(ValueError, match="user's model"):
        jobs.run_types(spark, root, dataset, specs, "d", 4, embed.UserModel("row_measures", "1", row_measures), as_entries=True)
