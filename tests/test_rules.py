"""Hand-worked cases for the rules that are easy to get wrong."""

import hashlib
import json
import math
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellshift import model
from cellshift.functions import cursors, text
from cellshift.functions.vectors import cosine_distance
from cellshift.operators import (
    cohorts,
    compare,
    embed,
    gold,
    perturb,
    profile,
    quality,
    ranks,
    resting,
    specs as sp,
)
from cellshift.operators.numbering import with_ordinal
from cellshift.plans import jobs
from cellshift.session import shared_path
from cellshift.sources import tables
from tests import fixtures as fx


@pytest.fixture(scope="module")
def run(spark):
    specs = sp.with_experiment_ids(fx.specs(spark).withColumn("run_id", F.lit("r")))
    return specs, fx.cells(spark), fx.genes(spark), fx.expression(spark)


@pytest.fixture(scope="module")
def delta(run):
    return perturb.delta_table(*run).cache()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- cohorts -----------------------------------------------------------------


def counts(df):
    return [r.n_target_cells for r in df.orderBy("experiment_id").collect()]


def test_empty_list_selects_nothing_at_execution_and_everything_at_comparison(run):
    specs, cells, _, _ = run
    assert counts(cohorts.target_cell_counts(specs, cells)) == [12, 6, 4, 2, 12, 0, 12, 0, 3, 12]
    assert counts(cohorts.target_cell_counts(specs, cells, "comparison")) == [
        12, 6, 4, 2, 12, 12, 12, 12, 3, 12,
    ]


def test_members_equal_counts_and_repeated_targets_count_once(run):
    specs, cells, _, _ = run
    members = cohorts.cohort_members(specs, cells, "execution")
    assert members.count() == members.distinct().count() == 12 + 6 + 4 + 2 + 12 + 12 + 3 + 12


def test_missing_attribute_is_an_error_at_execution_and_no_cell_at_comparison(run):
    specs, cells, _, _ = run
    bare = cells.drop("donor")
    assert counts(cohorts.target_cell_counts(specs, bare, "comparison"))[2] == 0
    with pytest.raises(Exception, match="target_donors provided but 'donor' is missing"):
        cohorts.target_cell_counts(specs, bare).collect()


def test_involved_values_cover_all_cells(spark):
    row = cohorts.involved_values(fx.cells(spark)).first()
    assert row.involved_donors == ["donor_01", "donor_02", "donor_03"]
    assert row.involved_cell_types == ["B_cell", "T_cell"]
    bare = cohorts.involved_values(fx.cells(spark).drop("donor")).first()
    assert bare.involved_donors == []


# --- matrix changes ----------------------------------------------------------


@pytest.mark.parametrize("i", range(len(fx.SPECS)))
def test_matrix_after_each_experiment(run, delta, i):
    specs, _, _, expression = run
    got = perturb.perturbed_matrix([("r", f"exp_{i:04d}")], specs, expression, delta).collect()
    wanted = fx.perturbed(fx.SPECS[i])
    assert {(r.cell_id, r.gene_symbol): pytest.approx(r.value, abs=1e-6) for r in got} == wanted


def test_knockout_leaves_zero_everywhere_it_touches(delta):
    assert delta.where("experiment_id IN ('exp_0000', 'exp_0003') AND new_value <> 0").count() == 0


def test_shift_fills_zeros_of_its_cohort_only(delta):
    filled = delta.where("experiment_id = 'exp_0002' AND old_value = 0")
    cells = {r.cell_id for r in filled.collect()}
    assert cells and all(int(c[-6:]) % 3 == 1 for c in cells)


def test_negative_base_is_clipped_by_shifting_experiments_only(spark, run, delta):
    specs = run[0]
    base = spark.createDataFrame([("cell_000011", "GENE0005", -2.0)], model.EXPRESSION)
    nothing = delta.where("false")
    after = lambda e: perturb.perturbed_matrix([("r", e)], specs, base, nothing).count()
    assert after("exp_0002") == 0
    assert after("exp_0000") == 1


def test_dense_rows_are_made_last_and_not_shuffled_for_their_values(spark, rows):
    """a cell brings its values along; repeats, nulls and zeros as in a left join."""
    cells = spark.createDataFrame([("a", "d", "t"), ("b", None, "t"), ("b", None, "t"), (None, "d", "t")], "cell_id string, donor string, cell_type string")
    entries = [("a", "GENE0001", 2.0), ("a", "GENE0001", 3.0), ("b", "GENE0001", None), ("b", "GENE0002", 5.0), (None, "GENE0001", 7.0), ("a", None, 1.0)]
    expression = spark.createDataFrame(entries, "cell_id string, gene_symbol string, value double")
    specs = sp.with_experiment_ids(fx.specs(spark, [("gene_activation", None, ["GENE0001", "GENE0003"], None, 1.0, None, None)]).withColumn("run_id", F.lit("r")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dense = perturb.dense_targets(specs, cells, fx.genes(spark), expression)
        last = next(line for line in plan_of(dense).splitlines() if "Join" in line)
        assert "_class" in last and "cell_id" not in last
        got = rows(dense, "cell_id", "gene_symbol", "value")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    first = [("a", 2.0), ("a", 3.0), ("b", 0.0), ("b", 0.0), (None, 0.0)]
    wanted = [(c, "GENE0001", v) for c, v in first] + [(c, "GENE0003", 0.0) for c in ("a", "b", "b", None)]
    assert got == sorted(wanted, key=repr)


# --- specs -------------------------------------------------------------------


def test_an_empty_gene_list_wins_over_a_gene(spark):
    specs = fx.specs(spark, [("gene_knockout", "GENE0001", [], None, None, None, None)])
    problems = sp.invalid_specs(specs, fx.genes(spark)).collect()
    assert [(r.position, r.reason) for r in problems] == [(0, "no valid gene")]


def test_ordinals_do_not_depend_on_blocks(spark):
    rows = [("a" if i % 3 else "b", i * 7) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, p bigint")
    got = with_ordinal(df, ["g"], "p", "k", block=50).collect()
    for g in "ab":
        ordered = sorted((r.p, r.k) for r in got if r.g == g)
        assert [k for _, k in ordered] == list(range(len(ordered)))


def test_batches_keep_list_order(spark):
    made = sp.batches(fx.specs(spark), 4).orderBy("batch_index").collect()
    assert [[m.position for m in r.perturbations] for r in made] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert made[0].perturbation_types == ["gene_activation", "gene_knockout", "gene_overexpression"]
    assert sp.batch_summary(fx.specs(spark), 0).first().n_batches == 10


def test_config_documents(spark, tmp_path):
    config = {
        "perturbation_types": ["gene_knockout"],
        "perturbations": [
            {"gene": "GENE0002", "perturbation_type": "gene_knockout", "target_donors": []},
            {"gene": "GENE0001", "perturbation_type": "gene_knockout", "target_cell_types": ["T_cell"]},
        ],
    }
    (tmp_path / "a.json").write_text(json.dumps(config, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"perturbations": []}))
    configs = tables.read_config(spark, str(tmp_path))
    specs = tables.config_specs(configs).orderBy("position").collect()
    assert [(r.position, r.gene, r.target_donors) for r in specs] == [(0, "GENE0002", []), (1, "GENE0001", None)]
    problems = tables.config_problems(configs).collect()
    assert [(r.config_file.rsplit("/", 1)[1], r.missing) for r in problems] == [("b.json", "perturbation_types")]
    assert tables.declared_types(configs).count() == 1


# --- profile -----------------------------------------------------------------


def test_totals_include_empty_cells_and_genes(spark):
    cells, expression = fx.cells(spark), fx.expression(spark)
    totals = {r.cell_id: (r.total, r.detected) for r in profile.cell_totals(cells, expression).collect()}
    assert totals["cell_000010"] == (0.0, 0)
    assert len(totals) == 12
    only = expression.where("gene_symbol <> 'GENE0005'")
    genes = {r.gene_symbol: r.total for r in profile.gene_totals(fx.genes(spark), only).collect()}
    assert genes["GENE0005"] == 0.0


def test_categories_that_never_occur_are_listed(spark):
    domain = spark.createDataFrame([("T_cell",), ("NK_cell",), ("B_cell",)], "category string")
    got = profile.category_counts(fx.cells(spark), "cell_type", 20, domain).collect()
    assert [(r.category, r.n) for r in got] == [("B_cell", 6), ("T_cell", 6), ("NK_cell", 0)]
    donors = profile.category_counts(fx.cells(spark), "donor").collect()
    assert (None, 1) in [(r.category, r.n) for r in donors]


def test_overview_of_nothing(spark):
    none = fx.expression(spark).where("false")
    row = profile.matrix_overview(fx.cells(spark).where("false"), fx.genes(spark), none).first()
    assert (row.density, row.min_value, row.max_value) == (0.0, 0.0, 0.0)


def test_describe_uses_the_sample_deviation(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "x double")
    row = profile.describe(df, "x").first()
    assert row.std == pytest.approx(math.sqrt(5 / 3))
    assert row.p50 == 2.5 and row.p01 == pytest.approx(1.03)


# --- percentiles -------------------------------------------------------------


def test_cohorts_do_not_depend_on_chunks(run, rows):
    specs, cells = run[0], run[1]
    whole = rows(cohorts.cohort_members(specs, cells, "execution"))
    split = cohorts.cohort_members(specs, cells, "execution", chunk=2)
    assert rows(split) == whole and len(whole) > 0
    assert rows(cohorts.cohort_members(specs, cells.limit(0), "execution")) == []


def test_cohorts_are_dealt_by_the_rows_they_make(run, rows, monkeypatch):
    """few bytes meet and many rows come out, all of which one task made."""
    specs, cells = run[0], run[1]
    whole = cohorts.cohort_members(specs, cells, "execution")
    assert "REPARTITION_BY_NUM" not in plan_of(whole)
    monkeypatch.setattr(cohorts.each_cell, "__defaults__", (cohorts.CHUNK, 10, 1))
    split = cohorts.cohort_members(specs, cells, "execution")
    assert plan_of(split).count("REPARTITION_BY_NUM") == 2
    assert split.rdd.getNumPartitions() >= 6 and rows(split) == rows(whole)


def test_shifts_of_zero_or_less_touch_stored_entries_only(run, delta, rows):
    """The zeros such a shift leaves at 0 are listed on request, and the changes are the same."""
    idle = perturb.delta_table(*run, idle=True)
    extra = idle.exceptAll(delta)
    assert extra.count() > 0 and extra.where("old_value <> 0 OR new_value <> 0").count() == 0
    assert delta.exceptAll(idle).count() == 0
    summary = {r.experiment_id: r for r in perturb.perturbation_summary(*run).collect()}
    changed = idle.where("new_value <> old_value").groupBy("experiment_id").count().collect()
    assert {e: r.n_changed for e, r in summary.items() if r.n_changed} == {r.experiment_id: r["count"] for r in changed}
    new = idle.where("old_value = 0 AND new_value <> 0").groupBy("experiment_id").count().collect()
    assert {e: r.n_new_non_zero for e, r in summary.items() if r.n_new_non_zero} == {r.experiment_id: r["count"] for r in new}


def test_order_keys_are_those_of_doubles(spark):
    """Every power of two with its neighbours, subnormal numbers, zeros, infinities, NaN, random bits."""
    random.seed(3)
    powers = [2.0**e for e in range(-1074, 1024)]
    numbers = [math.nextafter(p, towards) for p in powers for towards in (0.0, p, math.inf)]
    numbers += [struct.unpack("d", random.randbytes(8))[0] for _ in range(3000)]
    numbers += [0.0, -0.0, math.inf, math.nan, *[-x for x in numbers if not math.isnan(x)]]
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    for r in ranks.with_order_key(df, "v", "key").collect():
        bits = struct.unpack("q", struct.pack("d", abs(r.v)))[0] if r.v == r.v else 0x7FF8 << 48
        assert r.key == (-bits if r.v < 0 else bits)


def test_percentiles_equal_the_built_in_at_any_size(spark):
    """Groups of one row and of many blocks; a third of the rows are one value, others lie close together."""
    n = 4 * ranks.BLOCK
    x = (
        F.when(F.col("id") % 3 == 0, F.lit(1.5))
        .when(F.col("id") % 5 == 0, 1.5 + F.col("id") * 2.0**-50)
        .otherwise((F.col("id") * 7919 % 100003 - 40000) * F.pow(F.lit(10.0), F.col("id") % 7 - 3))
    )
    df = spark.range(n).select(F.when(F.col("id") < n - 40, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("k"), x.alias("x"))
    df = df.unionByName(spark.createDataFrame([("one", 9.0), ("flat", 1.0), ("flat", 1.0), ("two", -math.inf), ("two", math.inf), ("hot", None), ("none", None)], "k string, x double"))
    probabilities, names = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0], list("abcdefg")
    data = ranks.values(df, ["k"], F.col("x"))
    got = {r.k: tuple(r)[2:] for r in ranks.percentiles(data, ["k"], probabilities, names).where("k <> 'two'").collect()}
    built_in = F.percentile("x", F.array(*[F.lit(p) for p in probabilities])).alias("p")
    want = {r.k: tuple(r.p) for r in df.where("k NOT IN ('two', 'none')").groupBy("k").agg(built_in).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-15) for k in want)
    ends = ranks.percentiles(data.where("k = 'two'"), ["k"], [0.0, 0.5, 1.0], ["low", "mid", "high"]).first()
    assert (ends.low, ends.high) == (-math.inf, math.inf)
    assert ranks.percentiles(data.limit(0), ["k"], [0.5], ["m"]).count() == 0


def test_nan_is_above_all_numbers_and_missing_in_descriptions(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (math.nan,), (None,)], "x double")
    at = ranks.percentiles(ranks.values(df.withColumn("k", F.lit("a")), ["k"], F.col("x")), ["k"], [0.5, 1.0], ["m", "top"]).first()
    assert at.n == 4 and at.m == 2.5 and math.isnan(at.top)
    row = profile.describe(df, "x").first()
    assert (row.n, row.mean, row.p50, row.p99, row["max"]) == (3, 2.0, 2.0, pytest.approx(2.98), 3.0)
    nothing = profile.describe(df.where("x IS NULL"), "x").first()
    assert nothing.n == 0 and nothing.p50 is None and nothing["max"] is None


def test_top_categories_equal_one_column_at_a_time(spark):
    df = spark.createDataFrame([(i, f"c{i * i % 11}", None if i % 4 == 0 else f"d{i % 30:02d}", i % 3 == 0) for i in range(90)], "id long, a string, b string, f boolean")
    domain = {"a": spark.createDataFrame([("c1",), ("zz",)], "category string")}
    got = profile.top_categories([("s", df, ["a", "b", "f"])], 12, domain).collect()
    for column in ("a", "b", "f"):
        one = profile.category_counts(df, column, 12, domain.get(column)).collect()
        assert {(r.category, r.n) for r in got if r.column_name == column} == {(r.category, r.n) for r in one}


def test_ranks_of_unions_equal_sorting_them(spark):
    """Unions of large shared classes with some values taken out and others put in."""
    random.seed(11)
    classes = {c: [random.choice([0.0, 0.5, random.random(), 1 + random.random() * 1e-9]) for _ in range(3000)] for c in "abc"}
    unions = {"k1": "a", "k2": "abc", "k3": "bc", "k4": ""}
    counted = [(c, v, vs.count(v)) for c, vs in classes.items() for v in set(vs)]
    shared = spark.createDataFrame(counted, "cid string, v double, n long")
    members = spark.createDataFrame([(k, c) for k, cs in unions.items() for c in cs], "k string, cid string")
    held, own, wanted = {}, [], []
    for k, cs in unions.items():
        every = [v for c in cs for v in classes[c]]
        gone = random.sample(every, len(every) // 3)
        more = [random.random() * 2 for _ in range(700)]
        own += [(k, v, more.count(v) - gone.count(v)) for v in {*gone, *more}]
        for v in gone:
            every.remove(v)
        held[k] = sorted(every + more)
        size = len(held[k])
        wanted += [(k, r, size) for r in {0, size // 4, (size - 1) // 2, size // 2, size - 1, size}]
    frames = [spark.createDataFrame(own, "k string, v double, n long"), ["k"], spark.createDataFrame(wanted, "k string, rank long, n long")]
    got = {(r.k, r.rank): r.value for r in ranks.at_ranks_of_unions(shared, members, *frames).collect()}
    assert got == {(k, r): held[k][r] for k, r, size in wanted if r < size}


def test_ranks_of_unions_read_what_is_moved_twice(spark):
    """Keys of the same classes share a union, and the moved rows are not read once a pass."""
    seen = spark.sparkContext.accumulator(0)

    def told(v):
        seen.add(1)
        return v

    values = [i / 5000 + 0.25 for i in range(5000)]
    shared = spark.createDataFrame([("a", v, 1) for v in values], "cid string, v double, n long")
    names = [f"k{i}" for i in range(12)]
    members = spark.createDataFrame([(k, "a") for k in names], "k string, cid string")
    moved = [(k, v, n) for i, k in enumerate(names) for v, n in ((values[i * 3], -1), (2.0, 1), (values[7], 1), (values[7], -1))]
    once = F.udf(told, "double").asNondeterministic()
    own = spark.createDataFrame(moved, "k string, v double, n long").withColumn("v", once("v"))
    wanted = spark.createDataFrame([(k, r, 5000) for k in names for r in (0, 2499, 2500, 4999)], "k string, rank long, n long")
    got = {(r.k, r.rank): r.value for r in ranks.at_ranks_of_unions(shared, members, own, ["k"], wanted).collect()}
    for i, k in enumerate(names):
        held = sorted([*values[: i * 3], *values[i * 3 + 1 :], 2.0])
        assert [got[k, r] for r in (0, 2499, 2500, 4999)] == [held[r] for r in (0, 2499, 2500, 4999)]
    assert seen.value <= 2 * len(moved)


def test_resting_summary_equals_brute_force(spark):
    """Three experiments move some of 300 cells; many cells share a resting distance."""
    cells = [(c, f"d{c % 3}" if c % 7 else None, f"t{c % 2}", 0.25 if c % 3 == 0 else (c * 31 % 97) / 60) for c in range(300)]
    rest = spark.createDataFrame(cells, "cell_id bigint, donor string, cell_type string, distance double")
    lists = {"exp_0000": (None, None), "exp_0001": (["d1"], []), "exp_0002": (["d0", "d2"], ["t1"]), "exp_0003": (["none"], None)}
    specs = spark.createDataFrame(
        [("r", e, d, t) for e, (d, t) in lists.items()],
        "run_id string, experiment_id string, target_donors array<string>, target_cell_types array<string>",
    )

    def target(e, donor, kind):
        d, t = lists[e]
        return (not d or donor in d) and (not t or kind in t)

    moved = {
        ("exp_0000", c): (c * 13 % 29) / 20 for c in range(0, 300, 2)
    } | {("exp_0001", c): 0.9 for c in range(1, 300, 3)} | {("exp_0002", 5): 2.0}
    dist = spark.createDataFrame(
        [("r", e, c, v, cells[c][3], target(e, cells[c][1], cells[c][2])) for (e, c), v in moved.items()],
        "run_id string, experiment_id string, cell_id bigint, distance double, rest double, is_target boolean",
    )
    got = {r.experiment_id: r for r in resting.resting_summary(dist, rest, specs).collect()}
    for e in lists:
        values = [moved.get((e, c), cells[c][3]) for c in range(300)]
        subset = [moved.get((e, c), cells[c][3]) for c in range(300) if target(e, cells[c][1], cells[c][2])]
        mean = sum(values) / 300
        middle = lambda v: sorted(v)[(len(v) - 1) // 2] / 2 + sorted(v)[len(v) // 2] / 2
        r = got[e]
        assert (r.n_cells, r.n_target_cells) == (300, len(subset))
        assert r.mean_distance == pytest.approx(mean)
        assert r.median_distance == pytest.approx(middle(values))
        assert r.std_distance == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / 300))
        assert (r.min_distance, r.max_distance) == pytest.approx((min(values), max(values)))
        if subset:
            assert r.mean_distance_target_subset == pytest.approx(sum(subset) / len(subset))
            assert r.median_distance_target_subset == pytest.approx(middle(subset))
        else:
            assert r.mean_distance_target_subset is None and r.median_distance_target_subset is None


# --- vectors and models ------------------------------------------------------


def test_cosine_distance_edges(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-2.0, 0.0]), ([0.0, 0.0], [0.0, 0.0]), ([3.0, 0.0], [0.0, 1.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>").coalesce(1)
    got = [r[0] for r in df.select(cosine_distance("a", "b")).collect()]
    assert got[:4] == pytest.approx([0.0, 2.0, 1.0, 1.0]) and got[4] is None


def test_vectors_of_unequal_width_are_refused(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="widths differ"):
        df.select(cosine_distance("a", "b")).collect()


def test_wide_projection_equals_the_narrow_one(spark):
    cells, expression = fx.cells(spark), fx.expression(spark)
    wide = embed.baseline_embeddings(cells, expression, 150)
    narrow = embed.baseline_embeddings(cells, expression, 40)
    full = {r.cell_id: r.vector for r in wide.collect()}
    for r in narrow.collect():
        assert len(full[r.cell_id]) == 150
        assert full[r.cell_id][:40] == pytest.approx(r.vector)


def test_user_model_must_return_the_declared_width(spark):
    bad = lambda genes, values: [[1.0, 2.0] for _ in genes]
    with pytest.raises(Exception, match="model returned shape"):
        embed.embed_with(fx.expression(spark), ["cell_id"], bad, 3).collect()


def test_distance_of_untouched_cells_is_zero(run, delta):
    _, cells, _, expression = run
    base = embed.baseline_embeddings(cells, expression, 8)
    changed = embed.changed_embeddings(delta, base, 8)
    touched = delta.where("old_value <> new_value").select("experiment_id", "cell_id").distinct()
    assert changed.count() == touched.count()


def test_baseline_vectors_are_summed_where_a_cells_entries_meet(spark):
    """partial vectors, 512 sums an entry, must not be what is shuffled."""
    cells = spark.createDataFrame([("a",), ("b",), ("none",), ("unknown",), ("many",)], "cell_id string")
    rows = [("a", "G1", 3.0), ("a", "G2", 1.0), ("a", "G2", 1.0), ("b", "G1", None), ("b", "G3", 2.0), ("unknown", "G1", None), (None, "G1", 1.0)]
    rows += [("many", f"H{i}", 1.0) for i in range(9000)]
    df = embed.baseline_embeddings(cells, spark.createDataFrame(rows, "cell_id string, gene_symbol string, value double"), 70)
    assert "partial_sum" not in plan_of(df) and "Generate" not in plan_of(df)

    def vector(entries):
        out = [0.0] * 70
        for gene, value in entries:
            code = int(hashlib.md5(gene.encode()).hexdigest()[:6], 16) * 7919 % embed.MODULUS
            for d in range(70):
                out[d] += math.log1p(value) * ((code + d * embed.STEP) % embed.MODULUS / embed.MODULUS - 0.5)
        return pytest.approx(out, abs=1e-6)

    got = {r.cell_id: r.vector for r in df.collect()}
    assert got["a"] == vector([("G1", 3.0), ("G2", 1.0), ("G2", 1.0)])
    assert got["b"] == vector([("G3", 2.0)])
    assert got["many"] == vector([(f"H{i}", 1.0) for i in range(9000)])
    assert got["none"] == [0.0] * 70 and got["unknown"] == [None] * 70


def test_vectors_are_measured_where_they_are_made(run, delta):
    """the same distances without sending each vector out and back in."""
    specs, cells, _, expression = run
    base = embed.baseline_embeddings(cells, expression, 8)
    key = lambda r: (r.experiment_id, r.cell_id)
    changed = embed.changed_embeddings(delta, base, 8, measured=True)
    assert "after" not in changed.columns
    got = {key(r): r for r in compare.changed_distances(changed, cells, specs).collect()}
    wanted = compare.changed_distances(embed.changed_embeddings(delta, base, 8), cells, specs).collect()
    assert len(got) == len(wanted) > 0
    for r in wanted:
        assert got[key(r)].distance == pytest.approx(r.distance)
        assert (got[key(r)].rest, got[key(r)].is_target) == (r.rest, r.is_target)


def test_vectors_of_filled_zeros_are_made_where_cell_and_experiment_meet(spark):
    """a row per cell and experiment must not be shuffled and grouped to make its vector."""
    up = [
        ("gene_activation", None, ["GENE0001", "GENE0002", "GENE0002"], None, 0.35, None, None),
        ("gene_activation", "GENE0003", None, 2.0, 1.5, ["donor_02", "donor_03"], ["T_cell"]),
        ("gene_activation", "GENE0005", None, None, 1e-300, None, None),
        *fx.SPECS,
    ]
    specs = sp.with_experiment_ids(fx.specs(spark, up).withColumn("run_id", F.lit("r")))
    cells = fx.cells(spark)
    twice = cells.where("cell_id IN ('cell_000003', 'cell_000011')")  # once more alike, once in another class
    cells = cells.unionByName(twice.withColumn("cell_type", F.when(F.col("donor").isNull(), "T_cell").otherwise(F.col("cell_type"))))
    cells = cells.unionByName(cells.limit(1).withColumn("cell_id", F.lit(None).cast("string")))
    more = [("cell_000000", "GENE0001", 2.0), ("cell_000002", "GENE0001", None), ("cell_000004", "GENE0002", -0.5), ("cell_000005", "GENE0003", 1e9)]
    expression = fx.expression(spark).unionByName(spark.createDataFrame(more, model.EXPRESSION))
    genes, base = fx.genes(spark), embed.baseline_embeddings(cells, expression, 8)
    delta = perturb.delta_table(specs, cells, genes, expression)
    for measured, name in ((False, "after"), (True, "distance")):
        got, wanted = (
            sorted((r.experiment_id, r.cell_id, r.before, r[name]) for r in df.collect())
            for df in (
                embed.perturbed_embeddings(specs, cells, genes, expression, base, 8, measured=measured),
                embed.changed_embeddings(delta, base, 8, measured=measured),
            )
        )
        assert [r[:3] for r in got] == [r[:3] for r in wanted] and len(got) > 40
        assert np.array([r[3] for r in got]) == pytest.approx(np.array([r[3] for r in wanted]), abs=1e-12)
    once = cells.where("cell_id < 'cell_000003'")
    made = perturb.filled_lists(specs, once, genes, expression, base, embed.gene_code, lambda old, new: new - old)
    above = plan_of(made).split("Join")[0]
    assert "Exchange" not in above and "Aggregate" not in above and made.count() > 3


def test_rows_of_a_user_model_are_put_together_a_call_at_a_time(monkeypatch):
    """F8: what a changed cell costs besides the model itself is shared by a call."""
    entry = pa.list_(pa.struct([("gene_symbol", pa.int64()), ("value", pa.float64())]))
    change = pa.struct([("run_id", pa.string()), ("experiment_id", pa.string()), ("e", entry)])
    listed = lambda row: [{"gene_symbol": g, "value": v} for g, v in row]
    bases = [[(2, 1.0), (5, 2.0), (5, 3.0), (9, 4.0)], []]
    rows = [[(2, 0.0)], [(5, 7.0)], [(1, 8.0), (9, 6.0)], [(7, 0.0)]] * 200
    changes = [[{"run_id": "r", "experiment_id": str(i), "e": listed(row)} for i, row in enumerate(rows)]] * 2
    batch = pa.RecordBatch.from_arrays(
        [pa.array([10, 11]), pa.array([listed(b) for b in bases], entry), pa.array(changes, pa.list_(change))],
        names=["cell_id", "base", "changes"],
    )
    seen, calls, isin = [], [], np.isin
    monkeypatch.setattr(np, "isin", lambda *a, **k: calls.append(1) or isin(*a, **k))

    def fn(genes, values):
        seen.extend([*zip(g.tolist(), v.tolist())] for g, v in zip(genes, values))
        return [[float(len(g))] for g in genes]

    out = pa.Table.from_batches(embed._changed_cells(batch, fn, 1)).to_pylist()
    wanted = [sorted([e for e in base if e[0] not in dict(row)] + [e for e in row if e[1]], key=lambda e: e[0]) for base in bases for row in rows]
    wanted = [[e for e in row if e[1]] for row in wanted]
    assert seen == wanted and len(calls) <= -(-len(wanted) // embed.CALL)
    assert [(r["cell_id"], r["experiment_id"], r["embedding"]) for r in out] == [
        (10 + i // 800, str(i % 800), [float(len(row))]) for i, row in enumerate(wanted)
    ]


# --- text and cursors --------------------------------------------------------


def test_slug_and_compact_tag(spark):
    df = spark.createDataFrame(
        [("T cell/é", ["b b", "a", " ", "c", "d"]), ("__", []), ("x" * 80, ["x" * 62 + "_y"])], "v string, l array<string>"
    )
    got = df.select(text.slug(F.col("v")).alias("s"), text.compact_tag(F.col("l")).alias("t")).collect()
    assert [r.s for r in got] == ["T_cell_é", "default", "x" * 80]
    assert [r.t for r in got] == ["a_b_b_c_more", "none", "x" * 62]


def test_cursor_forms(spark):
    forms = {"17": (17, 0), '{"id": 5, "run_updated_after": "2024-01-01T00:00:07Z"}': (5, 1704067207), "{bad": (0, 0),
             '{"id": "x"}': (0, 0), "": (0, 0)}
    df = spark.createDataFrame([(f,) for f in forms], "c string")
    c = F.col("c")
    for r in df.select(c, cursors.cursor_id(c).alias("i"), F.unix_seconds(cursors.cursor_time(c)).alias("t")).collect():
        assert (r.i, r.t) == forms[r.c]


def test_numbers_past_four_digits_stay_whole(spark):
    assert spark.range(12345, 12346).select(text.numbered_key("exp", F.col("id"))).first()[0] == "exp_12345"


# --- checks and documents ----------------------------------------------------


def test_checks_without_any_run_pass(spark, run):
    none = gold.manifest_records(run[0], run[1]).where("false")
    vectors = spark.createDataFrame([], model.EMBEDDINGS)
    row = quality.embedding_shape_check(none, vectors, 512).first()
    assert (row.passed, row.severity, row.n_runs) == (True, "WARN", 0)


def test_freshness_of_the_standard_outputs(spark):
    log = spark.sql(
        "SELECT * FROM VALUES ('preview_data', TIMESTAMP '2024-01-01 00:00:00'),"
        " ('preview_data', TIMESTAMP '2024-01-01 12:00:00'),"
        " ('perturbation_run', TIMESTAMP '2024-01-01 12:00:00') AS t(asset, ts)"
    )
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    got = {r.asset: r.passed for r in quality.freshness(log, quality.freshness_windows(spark), now).collect()}
    assert got["preview_data"] is True and got["perturbation_run"] is False
    assert got["synthetic_adata"] is False and len(got) == 6


def test_long_runs_go_on_in_further_documents(spark, run):
    records = gold.ui_records(gold.manifest_records(run[0], run[1]))
    documents = tables.run_documents(records, "position", size=4).orderBy("part").collect()
    assert [len(d.experiments) for d in documents] == [4, 4, 2]
    assert [e.experiment_id for e in documents[1].experiments] == [f"exp_{i:04d}" for i in range(4, 8)]


def test_writing_a_run_again_replaces_only_that_run(spark):
    path = shared_path(spark, "runs")
    both = spark.createDataFrame([("a", 1), ("b", 1)], "run_id string, v int")
    tables.write_by_run(path, both)
    tables.write_by_run(path, both.where("run_id = 'b'").withColumn("v", F.lit(2)))
    got = spark.read.schema("run_id string, v int").parquet(path).collect()
    assert sorted((r.run_id, r.v) for r in got) == [("a", 1), ("b", 2)]


def test_a_cluster_without_a_shared_folder_is_refused():
    from cellshift.session import shared_path as path

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        path(Session(), "x")


def test_a_field_missing_late_in_a_set_is_seen(spark):
    whole = {f: 1 for f in model.REQUIRED_SUMMARY_FIELDS}
    short = {f: 1 for f in model.REQUIRED_SUMMARY_FIELDS[1:]}
    rows = [("a", json.dumps(short if i == 59 else whole)) for i in range(60)]
    row = quality.comparison_manifest_check(spark.createDataFrame(rows, "s string, j string"), "s", "j").first()
    assert (row.n_experiments, row.n_missing, row.passed) == (60, 1, False)


def test_user_model_sees_cells_without_entries(spark):
    counts = lambda genes, values: [[len(g), float(sum(v))] for g, v in zip(genes, values)]
    some = fx.expression(spark).where("cell_id <> 'cell_000003'")
    out = embed.embed_with(some, ["cell_id"], counts, 2, fx.cells(spark))
    got = {r.cell_id: list(r.embedding) for r in out.collect()}
    assert len(got) == 12
    assert got["cell_000003"] == [0.0, 0.0]


def test_many_small_runs_are_a_file_each_and_not_one_task(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "concat('run', id % 40) AS run_id", "format_string('exp_%04d', id div 400) AS experiment_id", "id AS cell_id", "id div 400 AS position"
    )
    experiments = rows.select("run_id", "experiment_id").distinct()
    tables.write_by_experiment(f"{tmp_path}/vectors", rows, tables.groups_of(experiments))
    assert len(list((tmp_path / "vectors").glob("run_id=*/*.parquet"))) == 40
    documents = rows.groupBy("run_id", F.lit(0).alias("part")).agg(F.count("cell_id").alias("n"))
    jobs._write_run_documents(f"{tmp_path}/documents", documents)
    tables.write_by_run(f"{tmp_path}/records", documents)
    for name, kind in (("documents", "json"), ("records", "parquet")):
        files = list((tmp_path / name).glob(f"run_id=*/*.{kind}"))
        assert len(files) == 40 and len({f.name.split("-")[1] for f in files}) > 1  # of more than one task


def test_a_user_models_filled_rows_meet_their_cell_many_experiments_at_once(spark):
    """The changes of a cell are listed where it meets its experiments, the same as in the delta table."""
    up = [("gene_activation", None, ["GENE0001", "GENE0002"], None, 0.35 + i, None if i % 2 else ["donor_02"], None) for i in range(12)]
    specs = sp.with_experiment_ids(fx.specs(spark, [*up, *fx.SPECS]).withColumn("run_id", F.lit("r")))
    cells, genes = fx.cells(spark), fx.genes(spark)
    nameless = cells.limit(1).withColumn("cell_id", F.lit(None).cast("string"))
    more = [("cell_000000", "GENE0001", 2.0), ("cell_000002", "GENE0001", None), ("cell_000004", "GENE0002", -0.5)]
    expression = fx.expression(spark).unionByName(spark.createDataFrame(more, model.EXPRESSION))
    met = perturb.filled_changes(specs, cells, genes, expression, cells.select("cell_id"), 256).collect()
    assert len(met) == 12  # a row a cell, not one an experiment and cell
    got = sorted((c.experiment_id, r.cell_id, e.gene_symbol, e.value) for r in met for c in r.changes for e in c.e)
    fills = [r.experiment_id for r in sp.with_effect(specs).where("shift > 0").collect()]
    delta = perturb.delta_table(specs, cells, genes, expression).where("new_value <> old_value")
    wanted = [(r.experiment_id, r.cell_id, r.gene_symbol, r.new_value) for r in delta.collect() if r.experiment_id in fills]
    assert got == sorted(wanted) and len(wanted) > 100
    model_ = embed.UserModel("sums", "1", lambda genes, values: np.array([[v.sum(), len(v)] for v in values]))
    twice = cells.unionByName(cells.where("cell_id = 'cell_000003'")).unionByName(nameless)
    base = embed.baseline_of(cells, expression, 2, model_)
    tables_ = specs, twice, genes, expression
    vectors = embed.changed_of(*tables_, base, 2, model_)
    whole = embed.embed_changed(perturb.delta_table(*tables_), expression, model_.fn, 2).join(base.select("cell_id"), "cell_id")
    told = lambda df, v: sorted((r.experiment_id, r.cell_id, repr(r[v])) for r in df.collect())
    assert told(vectors, "after") == told(whole, "embedding")
