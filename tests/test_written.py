"""Written tables: access paths, kept sums, versions, seasonality kept up to date, pages and parts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from monthgrain.operators import catalog, export, families, season, series
from monthgrain.plans import BREAK_DATE, Store
from monthgrain.plans.incremental import SeasonState
from monthgrain.plans.versions import Conflict, VersionedTable
from monthgrain.plans.warehouse import GRAINS, WrittenStore
from monthgrain.schema import TABLES
from monthgrain.sources import literals
from monthgrain.sources.csv_parts import CsvParts


@pytest.fixture(scope="module")
def written(spark, small):
    return WrittenStore.of(spark, small)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df) -> str:
    """The plan before it runs, and before it is changed at run time."""
    return plan(df).partition("== Initial Plan ==")[2] or plan(df)


# --- access paths ------------------------------------------------------------------------------------


def test_facts_meet_without_a_shuffle(spark, written):
    """The only exchange is that of the cells which tasks have added up."""
    text = initial(written.panel.cells())
    assert text.count("Exchange ") == 1 and "SortMergeJoin" in text and "Bucketed: true" in text
    below = text[text.index("Exchange ") :]
    assert "partial_sum" in below and "hashpartitioning(c_nationkey" in below


def test_a_period_reads_its_months_only(spark, written):
    written.register()
    calls = [
        families.trend(spark, "pop5", "1996-01-01", "1996-03-01"), families.trend(spark, "pop5", "1996-01-01", "1996-03-01", split=True), families.pyramid(spark, "pop5", "1996-01-01"),
        families.pyramid(spark, "pop5", "1996-01-01", "00000001"), families.ranking(spark, "pop5", "1996-01-01", "2000-06-01"), families.trend(spark, "pop1", "1996-01-01", "1996-03-01"),
    ]
    for r in calls:
        filters = [line for line in plan(r.df).splitlines() if "PartitionFilters: [" in line and "reference_date" in line.partition("PartitionFilters: [")[2].partition("]")[0]]
        assert filters, plan(r.df)
    with_routes = families.trend(spark, "pop5", "1996-01-01", "1996-03-01", routes=written.routes)
    assert "PartitionFilters: [" in plan(with_routes.df) and "reference_date" in plan(with_routes.df).partition("PartitionFilters: [")[2].partition("]")[0]


@pytest.mark.parametrize("family,options,columns", [
    ("trend", {}, {"key_code", "muni_code", "reference_date"}), ("trend", {"keys": ["00000001", "00000006"]}, {"key_code", "muni_code", "reference_date"}), ("trend", {"split": True}, {"key_code", "muni_code", "reference_date"}),
    ("trend", {"measure": "foreign_population"}, {"key_code", "muni_code", "reference_date"}), ("pyramid", {}, {"muni_code", "reference_date", "age_class", "sex"}), ("ranking", {}, {"key_code", "muni_code", "reference_date"}),
])
def test_all_routes_give_the_same(spark, written, family, options, columns):
    """Every kept sum that covers a query gives what leaves give; the chooser takes the one of fewest rows."""
    written.register()
    dates = {"trend": ("1996-01-01", "1997-12-01"), "ranking": ("1996-01-01", "2000-06-01"), "pyramid": ("1996-01-01",)}[family]
    ask = lambda routes: getattr(families, family)(spark, "pop5", *dates, routes=routes, **options)
    leaves = ask(None)
    view = leaves.notes[0].split()[1]
    covering = written.routes.covering(view, columns)
    assert covering and [g.n_rows for g in covering] == sorted(g.n_rows for g in covering)

    class Only:
        def __init__(self, name):
            self.smallest = lambda view, columns: name

    want = sorted(map(tuple, leaves.df.collect()))
    for g in covering:
        assert sorted(map(tuple, ask(Only(g.name)).df.collect())) == want
    chosen = ask(written.routes)
    assert f"FROM {covering[0].name} " in chosen.sql and sorted(map(tuple, chosen.df.collect())) == want
    assert covering[0].n_rows < written.views[view].count()


def test_no_route_has_areas_and_ages(written):
    assert written.routes.smallest("v_population_5y", {"key_code", "age_class"}) == "v_population_5y"
    assert {g.view for g in written.routes.grains} == GRAINS.keys()


def test_kept_sums_are_made_of_kept_sums(written):
    """The coarsest sum of a view is added up from the next finer one, not from leaves."""
    at = [g for g in written.routes.grains if g.view == "v_population_5y"]
    assert at[-1].columns == ("muni_code", "reference_date") and at[-1].n_rows < min(g.n_rows for g in at[:-1])
    total = written.routes.frames[at[-1].name].agg(F.sum("value"), F.sum("n_rows")).first()
    assert tuple(total) == tuple(written.views["v_population_5y"].agg(F.sum("value"), F.count("*")).first())


def test_seasonality_starts_from_sums(spark, small):
    s = Store.of(spark, small)
    want = s.views["v_population_5y"].groupBy("muni_code", "key_code", "area_name", "reference_date").agg(F.sum("value").alias("population"))
    assert sorted(s.views["v_nl_population"].collect()) == sorted(want.collect())


@pytest.mark.parametrize("grain", ["nation", "region"])
def test_counted_rows_are_those_of_the_observations(spark, small, grain):
    s = Store.of(spark, small, grain)
    tables = [s.literal(t) for t in ("source_files", "dataset_sources", "datasets")]
    assert sorted(s.periods.collect()) == sorted(catalog.refresh_periods(*tables, s.observations_5y, s.observations_1y).collect())


# --- versions ----------------------------------------------------------------------------------------

KIND = TABLES["observations_1y"]


def rows(spark, *of):
    return spark.createDataFrame([(m, k, d, a, "male", v, "s") for m, k, d, a, v in of], KIND)


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), KIND, "reference_date", ["key_code", "reference_date", "age_class", "sex"])
    t.replace(rows(spark, ("m", "a", "2000-01-01", "0", 1), ("m", "a", "2000-02-01", "0", 2), ("n", "b", "2000-02-01", "0", 3), ("m", "a", "2000-03-01", "0", 4)))
    return t


def values(df):
    return sorted((r.key_code, r.reference_date, r.age_class, r.value) for r in df.collect())


def test_a_merge_writes_its_partitions_alone(spark, table, tmp_path):
    before = {f: os.stat(f).st_mtime_ns for f in (tmp_path / "t" / "data").rglob("part-*")}
    assert table.merge(rows(spark, ("m", "a", "2000-02-01", "0", 20), ("m", "a", "2000-02-01", "1", 21), ("m", "c", "2000-04-01", "0", 5))) == 2
    assert values(table.read()) == [("a", "2000-01-01", "0", 1), ("a", "2000-02-01", "0", 20), ("a", "2000-02-01", "1", 21), ("a", "2000-03-01", "0", 4), ("b", "2000-02-01", "0", 3), ("c", "2000-04-01", "0", 5)]
    new = [f for f in (tmp_path / "t" / "data").rglob("part-*") if f not in before]
    assert {f.parent.name for f in new} == {"reference_date=2000-02-01", "reference_date=2000-04-01"} and all(os.stat(f).st_mtime_ns == t for f, t in before.items())
    assert values(table.read(1)) == [("a", "2000-01-01", "0", 1), ("a", "2000-02-01", "0", 2), ("a", "2000-03-01", "0", 4), ("b", "2000-02-01", "0", 3)]


def test_slices_are_replaced_and_others_kept(spark, table):
    table.replace(rows(spark, ("m", "z", "2000-02-01", "0", 9)), ["muni_code", "reference_date"])
    assert values(table.read().filter("reference_date = '2000-02-01'")) == [("b", "2000-02-01", "0", 3), ("z", "2000-02-01", "0", 9)]
    table.replace(rows(spark, ("m", "z", "2000-01-01", "0", 9)).filter("false"), partitions=["2000-01-01"])
    assert not table.read().filter("reference_date = '2000-01-01'").count() and len(table.manifest()["partitions"]) == 2


def test_of_a_change_nothing_is_seen_before_its_manifest(spark, table, monkeypatch):
    def fails(*of):
        raise OSError("lost")

    want = values(table.read())
    monkeypatch.setattr(table.folder, "put", fails)
    with pytest.raises(OSError):
        table.merge(rows(spark, ("m", "a", "2000-01-01", "0", 7)))
    monkeypatch.undo()
    assert values(table.read()) == want and table.versions() == [1]
    assert table.merge(rows(spark, ("m", "a", "2000-01-01", "0", 7))) == 2 and table.vacuum() == 2  # one left by the failure, one replaced
    assert values(table.read())[0] == ("a", "2000-01-01", "0", 7) and table.versions() == [2]


def test_of_two_changes_at_once_one_fails(spark, table, monkeypatch):
    other = VersionedTable.open(spark, table.root, "reference_date", table.keys)
    held = table.manifest
    seen = held()
    other.merge(rows(spark, ("m", "a", "2000-01-01", "0", 7)))
    monkeypatch.setattr(table, "manifest", lambda version=None: seen)
    with pytest.raises(Conflict):
        table.merge(rows(spark, ("m", "a", "2000-01-01", "0", 8)))
    monkeypatch.undo()
    assert values(table.read())[0][-1] == 7 and len(json.loads(table.folder.text("manifest/000000000002.json"))["partitions"]) == 3


def test_a_table_of_nothing(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "none"), KIND, "reference_date", ["key_code"])
    assert t.read().collect() == [] and t.merge(rows(spark).limit(0)) == 0 and t.versions() == []
    with pytest.raises(ValueError):
        VersionedTable.open(spark, t.root, "reference_date")
    t.replace(rows(spark, ("m", "a", None, "0", 1)))
    assert t.merge(rows(spark, ("m", "a", None, "0", 2))) == 2 and t.read().filter("reference_date IS NULL").count() >= 1


# --- seasonality kept up to date ---------------------------------------------------------------------


def panel_rows(spark, n_areas=12, months=60, skip=(), other=()):
    out = []
    for a in range(n_areas):
        for i in range(months):
            if (a, i) not in skip:
                out.append((f"k{a:02d}", f"A{a}", f"{1990 + i // 12}-{i % 12 + 1:02d}-01", 100 + (i * (7 + a)) % 12 + i + (1000 if (a, i) in other else 0)))
    return season.month_panel(spark.createDataFrame(out, "key_code string, area_name string, reference_date string, value long"), "value", "0000")


def test_only_changed_areas_are_made_anew(spark, tmp_path):
    full = panel_rows(spark)
    state = SeasonState(spark, str(tmp_path / "s"), buckets=8)
    state.load(panel_rows(spark, skip={(3, 30)}, other={(5, 10)}))
    late = full.filter("(key_code = 'k03' AND month_index = 1990 * 12 + 31) OR (key_code = 'k05' AND month_index = 1990 * 12 + 11)")
    assert late.count() == 2
    changes = late.select(state._bucket(), "*")
    assert state.near(changes, 6).count() == 2 * 13
    before = {t: t.manifest()["partitions"] for t in (state.values, state.ratios, state.index)}
    touched = state.update(late)
    assert state.needed(changes).count() == 25 + 23 and len(touched) <= 2  # k05's month is the eleventh: 23 months within 12 of it
    for t, held in before.items():
        now = t.manifest()["partitions"]
        assert {k for k in now if now[k] != held.get(k)} <= {f"bucket={b}" for b in touched}
    want = season.seasonal_index(full)
    assert sorted(state.index.read().drop("bucket").collect()) == sorted(want.collect())
    ratios = lambda df: sorted((r.key_code, r.month_index, round(r.ratio, 9)) for r in df.collect())
    assert ratios(state.ratios.read()) == ratios(season.ratios(full, season.AREA))


def test_an_area_that_loses_its_index(spark, tmp_path):
    """A change after which no month has a trend leaves the area without rows; others of its partition stay."""
    state = SeasonState(spark, str(tmp_path / "s"), buckets=1, min_trend=50)
    state.load(panel_rows(spark, 2, 30))
    zero = panel_rows(spark, 2, 30).filter("key_code = 'k01'").withColumn("value", F.lit(0).cast("long"))
    state.update(zero)
    assert {r.key_code for r in state.index.read().collect()} == {"k00"} and state.update(zero.limit(0)) == []


# --- coverage by bits --------------------------------------------------------------------------------


def test_coverage_is_one_small_plan(spark, small):
    s = Store.of(spark, small)
    covered = catalog.coverage(s.periods, s.literal("dataset_gaps"), s.literal("datasets"))
    text = covered._jdf.queryExecution().toString()
    assert len(text) < 40_000 and "bitmap" in text.lower() and plan(covered).count("Generate") == 1


def test_bits_of_many_months(spark):
    """Months over centuries, some missing, some with files alone within and beyond the loaded ones, against plain sets."""
    import random

    rng = random.Random(4)
    known = {}
    for k in ("pop5", "pop1"):
        for m in rng.sample(range(1800 * 12, 2100 * 12), 900):
            known[k, m] = (rng.choice([0, 0, 1, 3]), rng.choice([0, 0, 7]))
    data = [(k, f"{(m - 1) // 12:04d}-{(m - 1) % 12 + 1:02d}-01", f, n) for (k, m), (f, n) in known.items()]
    periods = spark.createDataFrame(data, "dataset_key string, reference_date string, file_count long, obs_rows long")
    datasets = literals.frame(spark, "datasets")
    want = {}
    for k in ("pop5", "pop1"):
        loaded = {m for (q, m), (_, n) in known.items() if q == k and n > 0}
        filed = {m for (q, m), (f, n) in known.items() if q == k and n == 0 and f > 0}
        for m in range(min(loaded), max(loaded) + 1):
            want[k, m] = "ok" if m in loaded else "not_loaded" if m in filed else "missing"
        want |= {(k, m): "not_loaded" for m in filed if not min(loaded) <= m <= max(loaded)}
    covered = catalog.coverage(periods, literals.frame(spark, "dataset_gaps").limit(0), datasets).collect()
    got = {(r.dataset_key, int(r.ym[:4]) * 12 + int(r.ym[5:])): (r.state, r.files, r.obs_rows) for r in covered}
    assert got == {q: (state, *known.get(q, (0, 0))) for q, state in want.items()}
    for r in catalog.coverage_summary(periods, datasets).collect():
        own = [s for (k, _), s in want.items() if k == r.dataset_key]
        assert (r.months_expected, r.months_present, r.anomalies) == (len(own), own.count("ok"), len(own) - own.count("ok"))
    only_files = periods.withColumn("obs_rows", F.lit(0).cast("long"))
    assert {r.state for r in catalog.coverage(only_files, literals.frame(spark, "dataset_gaps"), datasets).collect()} == {"not_loaded"}
    assert catalog.coverage(periods.limit(0), literals.frame(spark, "dataset_gaps"), datasets).collect() == []


# --- as of, pages, parts -----------------------------------------------------------------------------


def test_as_of_by_plain_search(spark):
    import random

    rng = random.Random(6)
    day = lambda: f"{rng.randrange(1999, 2004)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"
    dates = [(rng.choice("ab"), day()) for _ in range(40)] + [("a", None), (None, "2001-01-01")]
    notes = [(i, rng.choice(["a", "b", "c", None]), day() if i % 9 else None) for i in range(120)] + [(500, *dates[0]), (501, *dates[0])]
    got = series.as_of(spark.createDataFrame(notes, "id long, k string, t string"), spark.createDataFrame(dates, "k string, t string"), "t", ("k",)).collect()
    assert len(got) == len(notes)
    for r in got:
        own = [t for k, t in dates if k == r.k and t is not None]
        assert r.before == max((t for t in own if r.t is not None and t <= r.t), default=None) and r.after == min((t for t in own if r.t is not None and t >= r.t), default=None)


def test_as_of_is_linear(spark):
    """No join of notes with dates: what is joined to the rows is a table with a row a stretch."""
    notes = spark.range(100).select(F.col("id"), F.format_string("20%02d-01-01", F.col("id") % 20).alias("t"))
    out = series.as_of(notes, notes, "t")
    text = initial(out)
    assert "NestedLoop" not in text and "Cartesian" not in text and text.count("Window ") == 4


def test_pages_by_keys_are_the_export(spark, small):
    s = Store.of(spark, small)
    s.register()
    r = export.export_rows(spark, "pop5", "population", "1996-01", "1997-12")
    order = ["reference_date", "key_code", "age_class", "sex"]
    index = export.PageIndex.of(r.df, order, 100)
    want = r.df.collect()
    n = -(-len(want) // 100)
    pages = [index.page(i).collect() for i in range(n)]
    assert [x for p in pages for x in p] == want and {len(p) for p in pages[:-1]} == {100} and index.page(n).collect() == []
    assert index.starts.count() == n


def test_a_page_reads_one_range(spark, small, written):
    written.register()
    r = export.export_rows(spark, "pop5", "population", "1996-01", "1997-12")
    page = export.PageIndex.of(r.df, ["reference_date", "key_code", "age_class", "sex"], 100).page(1)
    text = plan(page)
    assert "reference_date#" in text.partition("PartitionFilters: [")[2].partition("]")[0] and "Offset" not in text


def test_equal_keys_stay_on_one_page(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)] + [("c", i) for i in range(4)], "k string, v long")
    index = export.PageIndex.of(df, ["k"], 3)
    pages = [index.page(p.page).collect() for p in index.starts.orderBy("page").collect()]
    assert sorted(x.v for p in pages for x in p if x.k == "a") == list(range(5)) and sum(map(len, pages)) == 10


CELLS = [("a,b", 1, 1.5), ('q"x', None, -2.0), ("line\nend", 3, None), ("é", -4, 0.25), (None, 5, 7.0)]


def test_csv_parts(spark, tmp_path):
    spark.dataSource.register(CsvParts)
    path = str(tmp_path / "csv")
    kind = "t string, n long, x double"
    df = spark.createDataFrame(CELLS * 20, kind).repartitionByRange(4, "n", "x").sortWithinPartitions("n", "x")
    df.write.format("csv_parts").mode("overwrite").save(path)
    listed = json.loads((tmp_path / "csv" / "parts.json").read_text())
    assert sum(p["rows"] for p in listed["parts"]) == 100 and listed["columns"] == ["t", "n", "x"]
    for p in listed["parts"]:
        assert (tmp_path / "csv" / p["name"]).read_bytes().startswith(b"\xef\xbb\xbft,n,x\n")
    back = spark.read.format("csv_parts").schema(kind).load(path)
    assert back.collect() == df.collect()  # in the order of the rows that were written
    first = spark.read.format("csv_parts").schema(kind).option("first", 1).option("count", 1).load(path)
    assert first.count() == listed["parts"][1]["rows"] and first.rdd.getNumPartitions() == 1
    assert spark.read.format("csv_parts").load(path).columns == ["t", "n", "x"]
    df.limit(3).coalesce(1).write.format("csv_parts").mode("append").save(path)
    assert spark.read.format("csv_parts").schema(kind).load(path).count() == 103
    df.limit(3).coalesce(1).write.format("csv_parts").mode("overwrite").save(path)
    left = sorted(f.name for f in (tmp_path / "csv").iterdir() if f.suffix == ".csv")
    assert spark.read.format("csv_parts").schema(kind).load(path).count() == 3 and len(left) == 1


def test_a_failed_write_leaves_no_table(spark, tmp_path):
    spark.dataSource.register(CsvParts)
    path = str(tmp_path / "csv")
    bad = spark.range(10).repartition(2).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("t"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("csv_parts").mode("append").save(path)
    assert not (tmp_path / "csv" / "parts.json").exists()


def test_cells_are_written_as_by_column_functions(spark):
    from monthgrain import functions as fn
    from monthgrain.sources.csv_parts import cell

    got = spark.createDataFrame(CELLS, "t string, n long, x double").select(fn.csv_cell(F.col("t"))).collect()
    assert [r[0] for r in got] == [cell(t) for t, _, _ in CELLS]


def test_late_files_write_their_months_alone(spark, tmp_path):
    from monthgrain import streaming

    kind = "muni_code string, reference_date string, value long"
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    deliveries = [[("m", "2000-01-01", 1), ("m", "2000-02-01", 2), ("n", "2000-02-01", 3)], [("m", "2000-02-01", 5)], [("m", "2000-03-01", 6)]]
    for d in deliveries:
        spark.createDataFrame(d, kind).coalesce(1).write.mode("append").parquet(source)
        streaming.replace_months(spark.readStream.schema(kind).parquet(source), target, check).awaitTermination()
    assert sorted(map(tuple, streaming.current(spark, target).collect())) == [("m", "2000-01-01", 1), ("m", "2000-02-01", 5), ("m", "2000-03-01", 6), ("n", "2000-02-01", 3)]
    held = VersionedTable.open(spark, target, "reference_date")
    assert {k[-10:]: int(v.partition("-")[0]) for k, v in held.manifest()["partitions"].items()} == {"2000-01-01": 1, "2000-02-01": 2, "2000-03-01": 3}
    assert len(held.versions()) == 2  # older ones are deleted
    with pytest.raises(ValueError):
        streaming.current(spark, str(tmp_path / "none"))


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    """The batch's number is in the manifest: what was done before a failure isn't done again."""
    import shutil

    from monthgrain import streaming

    kind = "muni_code string, reference_date string, value long"
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.createDataFrame([("m", "2000-01-01", 1)], kind).coalesce(1).write.parquet(source)
    for _ in range(2):
        streaming.replace_months(spark.readStream.schema(kind).parquet(source), target, check).awaitTermination()
        shutil.rmtree(check)  # as if the stream had forgotten that it was done
    assert VersionedTable.open(spark, target, "reference_date").versions() == [1]


def test_gaps_since_a_later_break(spark, small):
    s = Store.of(spark, small)
    early = season.month_panel(s.views["v_nl_population"], "population", BREAK_DATE)
    late = season.month_panel(s.views["v_nl_population"], "population", "1997-07-01")
    assert late.count() < early.count() and late.agg(F.min("reference_date")).first()[0] >= "1997-07-01"


def test_a_delivery_touches_its_month_alone(spark, small):
    own = WrittenStore(spark, small)
    try:
        before = {g.name: own.routes.tables[g.name].manifest()["partitions"] for g in own.routes.grains}
        late = own.observations_5y.filter("reference_date = '1997-03-01' AND muni_code = '000001'")
        assert own.deliver(late.withColumn("value", F.col("value") + 7)) == ["1997-03-01"]
        assert {k: v.partition("-")[0] for k, v in own.table("observations_5y").manifest()["partitions"].items()}["reference_date=1997-03-01"] == "2"
        for g in own.routes.grains:
            now = own.routes.tables[g.name].manifest()["partitions"]
            assert {k for k in now if now[k] != before[g.name][k]} <= {"reference_date=1997-03-01"} and now.keys() == before[g.name].keys()
            fresh = own.views[g.view].withColumn("n_rows", F.lit(1).cast("long")).groupBy(*g.columns).agg(F.sum("value").alias("value"), F.sum("n_rows").alias("n_rows"))
            assert sorted(own.routes.frames[g.name].select(*fresh.columns).collect()) == sorted(fresh.collect())
        changed = own.views["v_nl_population"].filter("reference_date = '1997-03-01' AND muni_code = '000001'").agg(F.sum("population")).first()[0]
        leaves = own.views["v_population_5y"].filter("reference_date = '1997-03-01' AND muni_code = '000001'").agg(F.sum("value")).first()[0]
        assert changed == leaves
    finally:
        own.close()
        own.panel.close()
