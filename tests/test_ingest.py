"""CSV landing: header grouping, merge by name, lineage columns, guards, silver typing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pitchhouse.plans.silver import bronze_view, silver_view
from pitchhouse.sources.csv_bronze import NoSourceFiles, land_csv
from pitchhouse.sources.layers import write_table

FILE_1 = ("Div,Date,Time,HomeTeam,AwayTeam,FTHG,FTAG,FTR,AS,B365H,B365>2.5,MIX\n"
          "SP1,12/08/2022,20:00,Barcelona,Girona,2,1,H,9,1.5,1.9,7\n"
          "SP1,13/08/2022,,Real Madrid,Barcelona,0,0,D,4,2.2,2.0,3\n")
FILE_2 = ("Div,Date,Time,HomeTeam,AwayTeam,FTAG,FTHG,FTR,AS,BWH,MIX\n"
          "SP1,11/08/2023,21:00,Girona,Barcelona,3,1,A,12,3.1,high\n")


@pytest.fixture()
def raw_dir(tmp_dir):
    for name, text in (("LaLiga 22-23.csv", FILE_1), ("LaLiga 23-24.csv", FILE_2)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    return tmp_dir


def test_land_merges_by_name_and_tags_rows(spark, raw_dir):
    bronze = land_csv(spark, os.path.join(raw_dir, "*.csv"))
    cols = bronze.columns
    for c in ("B365H", "B365>2.5", "BWH", "MIX", "season", "_source_file", "_loaded_at"):
        assert c in cols
    assert all(t == "string" for c, t in bronze.dtypes if c != "_loaded_at")
    rows = {r["HomeTeam"]: r.asDict() for r in bronze.collect()}
    # FTHG/FTAG swapped in the second file are mapped by name
    assert (rows["Girona"]["FTHG"], rows["Girona"]["FTAG"]) == ("1", "3")
    # a column missing from a file is NULL, a text value of a numeric column stays text
    assert rows["Girona"]["B365H"] is None and rows["Barcelona"]["BWH"] is None
    assert rows["Girona"]["MIX"] == "high" and rows["Barcelona"]["MIX"] == "7"
    assert rows["Barcelona"]["B365>2.5"] == "1.9"
    # blank cell → NULL; season and file from the (space-containing) file name
    assert rows["Real Madrid"]["Time"] is None
    assert rows["Girona"]["season"] == "2023-24"
    assert rows["Barcelona"]["_source_file"] == "LaLiga 22-23.csv"


def test_silver_types_landed_text(spark, raw_dir):
    silver = silver_view(bronze_view(land_csv(spark, os.path.join(raw_dir, "*.csv"))))
    r = silver.where(F.col("home_team") == "Girona").first()
    assert r["match_date"] == dt.date(2023, 8, 11)
    assert (r["home_goals"], r["away_goals"], r["away_shots"]) == (1, 3, 12)
    assert r["home_goals_ht"] is None  # HTHG is absent from both files
    assert silver.count() == 3


def test_no_files_is_an_error_before_any_write(spark, tmp_dir):
    with pytest.raises(NoSourceFiles):
        land_csv(spark, os.path.join(tmp_dir, "*.csv"))


def test_file_name_without_season_fails_the_load(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "matches.csv"), "w") as f:
        f.write("Div,HomeTeam\nSP1,Girona\n")
    with pytest.raises(Exception):
        land_csv(spark, os.path.join(tmp_dir, "*.csv")).collect()


def test_table_write_is_idempotent(spark, raw_dir, tmp_dir):
    bronze = land_csv(spark, os.path.join(raw_dir, "*.csv")).drop("_loaded_at")
    path = os.path.join(tmp_dir, "bronze_matches")
    first = sorted(map(tuple, write_table(bronze, path=path).collect()))
    second = sorted(map(tuple, write_table(bronze, path=path).collect()))
    assert first == second and len(first) == 3


def test_catalog_table_and_view(spark, raw_dir):
    from pitchhouse.plans.silver import bronze_view_sql, silver_view_sql
    from pitchhouse.sources.layers import create_view
    bronze = land_csv(spark, os.path.join(raw_dir, "*.csv")).drop("_loaded_at")
    first = write_table(bronze, name="bronze.matches_raw").count()
    assert spark.catalog.databaseExists("bronze")
    again = write_table(bronze, name="bronze.matches_raw")  # CREATE OR REPLACE
    assert first == again.count() == 3
    create_view(spark, bronze_view_sql(bronze.columns, "bronze.matches_raw"), "bronze.bronze_matches")
    create_view(spark, silver_view_sql("bronze.bronze_matches"), "silver.silver_matches")
    other = spark.newSession().table("silver.silver_matches")  # the views outlive the session that made them
    want = silver_view(bronze_view(bronze))
    assert other.dtypes == want.dtypes
    assert sorted(map(str, other.collect())) == sorted(map(str, want.collect()))


def test_replaced_table_is_swapped_whole(spark):
    """A write that fails half-way leaves the old rows; an older reader can finish; old versions go."""
    from pitchhouse.sources.layers import versions
    first = write_table(spark.range(5).withColumn("k", F.col("id") % 2), name="bronze.swapped", partition_by=["k"])
    assert first.columns == ["id", "k"] and first.dtypes == [("id", "bigint"), ("k", "bigint")]
    broken = spark.range(4).withColumn("k", F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("long")))
    with pytest.raises(Exception, match="half-way"):
        write_table(broken, name="bronze.swapped", partition_by=["k"])
    assert spark.table("bronze.swapped").count() == 5 and len(versions(spark, "bronze.swapped")) == 1
    reader = spark.table("bronze.swapped")
    assert write_table(spark.range(7), name="bronze.swapped").count() == 7
    assert reader.count() == 5 and spark.table("bronze.swapped").columns == ["id"]
    write_table(spark.range(8), name="bronze.swapped")
    assert len(versions(spark, "bronze.swapped")) == 2 and spark.table("bronze.swapped").count() == 8
    spark.range(2).write.mode("overwrite").saveAsTable("bronze.plain")
    assert write_table(spark.range(3), name="bronze.plain").count() == 3


def test_optional_silver_cleaning(spark):
    rows = [("SP1", "12/08/2022", "20:00", " Girona ", "Barcelona", "1", "2", "A", "2022-23")] * 2
    df = spark.createDataFrame(rows, "Div string, Date string, Time string, HomeTeam string, "
                                     "AwayTeam string, FTHG string, FTAG string, FTR string, season string")
    plain = silver_view(bronze_view(df))
    clean = silver_view(bronze_view(df), trim_text=True).dropDuplicates()
    assert plain.count() == 2 and clean.count() == 1
    assert clean.first()["home_team"] == "Girona"


def test_full_refresh_from_csv_files(spark, raw_dir):
    from pitchhouse.plans import analytics
    from pitchhouse.plans.refresh import full_refresh
    first = full_refresh(spark, os.path.join(raw_dir, "*.csv"))
    assert spark.table("gold.fact_matches").count() == 3
    assert sorted(r["season_label"] for r in spark.table("gold.dim_season").collect()) == ["2022-23", "2023-24"]
    report = {(r["table_name"], r["column_name"], r["test_name"]): r["failures"] for r in first.tests.collect()}
    assert len(report) == 13 and sum(report.values()) == 0
    table = {r["team_name"]: (r["wins"], r["draws"], r["losses"]) for r in analytics.team_performance(first.gold).collect()}
    assert table == {"Barcelona": (2, 1, 0), "Girona": (0, 0, 2), "Real Madrid": (0, 1, 0)}
    again = full_refresh(spark, os.path.join(raw_dir, "*.csv"))  # idempotent
    assert sorted(map(tuple, spark.table("gold.fact_matches").collect())) == \
        sorted(map(tuple, again.gold.fact.collect()))


def test_source_files_forms(spark, tmp_dir):
    """Bare paths, URIs, nested wildcards and whole folders list the same files."""
    from pitchhouse.sources.csv_bronze import source_files
    for sub in ("a", "b/c"):
        os.makedirs(os.path.join(tmp_dir, sub))
        for name in ("LaLiga 22-23.csv", "notes.txt"):
            with open(os.path.join(tmp_dir, sub, name), "w") as f:
                f.write("x" * (1 + len(sub)))

    def found(pattern, **kw):
        return sorted((r["path"].removeprefix("file:"), r["bytes"]) for r in source_files(spark, pattern, **kw).collect())

    a, b = (os.path.join(tmp_dir, s, "LaLiga 22-23.csv") for s in ("a", "b/c"))
    assert found(tmp_dir + "/{a,b/c}/*.csv") == found("file:" + tmp_dir + "/{a,b/c}/*.csv") == \
        found("file://" + tmp_dir + "/{a,b/c}/*.csv") == [(a, 2), (b, 4)]
    assert found(tmp_dir + "/*/*/*.csv") == [(b, 4)]
    assert [p for p, _ in found(tmp_dir, recursive=True)] == sorted([a, b, a[:-16] + "notes.txt", b[:-16] + "notes.txt"])
    with pytest.raises(NoSourceFiles):
        source_files(spark, tmp_dir + "/*.csv")


#: Header lines as users have them, and records that go with them.
ODD_FILES = {
    "LaLiga 20-21.csv": 'HomeTeam,,FTHG,FTHG,,"Note, long"\nGirona,x,1,2,y,"one\ntwo"\nBetis,,3,4,,"say ""hi"""\n',
    "LaLiga 21-22.csv": '"Home\nGoals",HomeTeam,fthg\n7,Cadiz,5\n8,Eibar\n',
    "LaLiga 22-23.csv": "\ufeffHomeTeam,FTHG,Fthg,FTHG_1\r\nAlaves,1,2,3\r\n",
}


@pytest.fixture()
def odd_dir(tmp_dir):
    for name, text in ODD_FILES.items():
        with open(os.path.join(tmp_dir, name), "w", newline="", encoding="utf-8") as f:
            f.write(text)
    return tmp_dir


def test_header_names_as_duckdb(spark, odd_dir):
    import duckdb

    from pitchhouse.sources.csv_bronze import column_names, csv_headers
    got = {r["path"].rsplit("/", 1)[1].replace("%20", " "): (r["names"], r["spans"]) for r in csv_headers(spark, odd_dir + "/*.csv").collect()}
    for name in ODD_FILES:
        path = os.path.join(odd_dir, name)
        rel = duckdb.sql(f"SELECT * FROM read_csv('{path}', header=true, all_varchar=true, delim=',', quote='\"', escape='\"', null_padding=true)")
        assert got[name][0] == rel.columns
    assert [got[n][1] for n in sorted(got)] == [True, True, False]
    assert column_names("a,,A,a_1,") == ["a", "column1", "A_1", "a_1_1", "column4"]


def test_records_take_their_own_header(spark, odd_dir):
    """Line breaks in values and headers, empty and repeated names, short records."""
    bronze = land_csv(spark, odd_dir + "/*.csv")
    assert bronze.columns == ["HomeTeam", "column1", "FTHG", "FTHG_1", "column4", "Note, long", "Home\nGoals", "FTHG_1_1",
                              "season", "_source_file", "_loaded_at"]
    rows = {r["HomeTeam"]: r.asDict() for r in bronze.collect()}
    assert rows["Girona"]["Note, long"] == "one\ntwo" and rows["Betis"]["Note, long"] == 'say "hi"'
    assert (rows["Girona"]["column1"], rows["Girona"]["column4"]) == ("x", "y")
    assert (rows["Girona"]["FTHG"], rows["Girona"]["FTHG_1"]) == ("1", "2")
    assert rows["Cadiz"]["Home\nGoals"] == "7" and rows["Cadiz"]["FTHG"] == "5"
    assert rows["Eibar"]["FTHG"] is None and rows["Eibar"]["season"] == "2021-22"
    assert [rows["Alaves"][c] for c in ("FTHG", "FTHG_1", "FTHG_1_1")] == ["1", "2", "3"]


def test_a_record_beyond_its_header_fails(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "LaLiga 22-23.csv"), "w") as f:
        f.write("Div,HomeTeam\nSP1,Girona,9\n")
    with pytest.raises(Exception, match="more fields than the header"):
        land_csv(spark, os.path.join(tmp_dir, "*.csv")).collect()


TYPED_1 = ("n,x,big,flag,day,stamp,clock,mix,zero,only1,gone\n"
           "1,1.5,99999999999999999999,true,15/08/2022,2022-08-15 10:00:00,20:00,7,007,5,\n"
           "-2,2,1,false,01/02/2022,2022-08-16 11:30:00,21:15,8,1,6,\n")
TYPED_2 = ("day,n,x,big,flag,stamp,clock,mix,zero,gone\n"
           "2023-08-15,2.5,1e3,3,yes,2023-01-01,13:00,high,1,4\n"
           ",,.5,4,no,2023-01-02,,1,2,\n")


def test_inferred_types_as_duckdb(spark, tmp_dir):
    """Files typed one by one and united by name, as the source's loader does."""
    import duckdb

    from pitchhouse.sources.csv_bronze import columns_of_files, csv_headers
    from pitchhouse.sources.inference import typed
    for name, text in (("LaLiga 22-23.csv", TYPED_1), ("LaLiga 23-24.csv", TYPED_2)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    want = duckdb.sql(" UNION ALL BY NAME ".join(
        f"SELECT *, '{n}' AS _source_file FROM read_csv_auto('{os.path.join(tmp_dir, n)}', header=true, sample_size=-1)"
        for n in ("LaLiga 22-23.csv", "LaLiga 23-24.csv")))
    pattern = os.path.join(tmp_dir, "*.csv")
    got = typed(land_csv(spark, pattern), columns_of_files(csv_headers(spark, pattern))).drop("_loaded_at", "season")
    names = {"BIGINT": "bigint", "DOUBLE": "double", "HUGEINT": "decimal(38,0)", "BOOLEAN": "boolean", "DATE": "date",
             "TIMESTAMP": "timestamp_ntz", "TIME": "string", "VARCHAR": "string"}
    types = dict(zip(want.columns, map(str, want.types)))
    assert dict(got.dtypes) == {c: names[t] for c, t in types.items()}
    key = lambda r: str(r["x"])
    a = sorted((r.asDict() for r in got.collect()), key=key)
    b = sorted((dict(zip(want.columns, r)) for r in want.fetchall()), key=key)
    for x, y in zip(a, b, strict=True):
        for c in types:
            v = y[c].strftime("%H:%M") if isinstance(y[c], dt.time) else y[c]
            assert (str(x[c]) == str(v)) or x[c] == v, (c, x[c], v)


def test_type_bits_against_each_kind_alone(spark):
    """A value told by its shape reads as the same kinds as when every kind is tried,
    the days as Spark's own parser reads them, and the bits are evaluated once a value."""
    from functools import reduce
    from pitchhouse.sources import inference as I
    texts = ["true", "No", "nan", "-nan", ".", "-", "-0", "007", "1.", "-.5", "1e5", "+5", "9" * 18, "9" * 19, "-" + "9" * 38, "9" * 39,
             "9223372036854775807", "9223372036854775808", "29/02/2023", "29.2.2024", "31-4-2001", "04/31/2001", "13/13/2001", "00/01/2001",
             "0000-1-1", "2020-13-01", "2020-1-31", "2020-01-01 10:00", "2020-01-01T25:00", "24:00", "23:59", "x1", "Ñ", "\u0663", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    v = F.col("v")
    formats = {"day ymd": "yyyy-M-d", "day dmy": "d-M-yyyy", "day mdy": "M-d-yyyy"}
    shapes = {k: r"^\d{4}-\d{1,2}-\d{1,2}$" if k == "day ymd" else r"^\d{1,2}-\d{1,2}-\d{4}$" for k in formats}
    dashed = F.regexp_replace(v, "[/.]", "-")

    def alone(k):
        return dashed.rlike(shapes[k]) & F.try_to_date(dashed, formats[k]).isNotNull() if k in formats else I.reads(v, k)

    bits = [F.when(alone(k), 1 << i).otherwise(0) for i, k in enumerate(I.KINDS)]
    got = rows.select("v", I._bits(v).alias("got"), F.when(v != "", reduce(lambda a, b: a + b, bits)).alias("want")).collect()
    assert [(r["v"], r["got"]) for r in got] == [(r["v"], r["want"]) for r in got]
    plan = I.file_types(rows.withColumn("f", F.lit("a")), file_col="f")._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(x for x in plan.splitlines() if "bit_and" in x)
    assert "RLIKE" not in aggregate


def test_landing_by_many_layouts(spark, tmp_dir):
    """A column at more places than there are branches, at one place in all files, and in some
    files only; what the file's name gives is made once a file; a value beyond a narrow header fails."""
    from pitchhouse.sources import csv_bronze
    n = csv_bronze.MANY_PLACES + 3
    for i in range(n):
        names = ["first", *[f"p{j}" for j in range(i)], "moving"] + (["some"] if i % 2 else [])
        with open(os.path.join(tmp_dir, f"LaLiga {i:02d}-{i + 1:02d}.csv"), "w") as f:
            f.write(",".join(names) + "\n" + ",".join(f"{i}:{c}" for c in names) + "\n")
    landed = land_csv(spark, os.path.join(tmp_dir, "*.csv"))
    rows = {r["_source_file"]: r.asDict() for r in landed.collect()}
    for i in range(n):
        r = rows[f"LaLiga {i:02d}-{i + 1:02d}.csv"]
        assert (r["first"], r["moving"], r["season"]) == (f"{i}:first", f"{i}:moving", f"20{i:02d}-{i + 1:02d}")
        assert r["some"] == (f"{i}:some" if i % 2 else None)
        assert [r[f"p{j}"] for j in range(n - 1)] == [f"{i}:p{j}" if j < i else None for j in range(n - 1)]
    plan = landed._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan.split("Join")[0]
    with open(os.path.join(tmp_dir, "LaLiga 40-41.csv"), "w") as f:
        f.write("first,moving\n1,2,3\n")
    with pytest.raises(Exception, match="more fields than the header"):
        land_csv(spark, os.path.join(tmp_dir, "*.csv")).collect()
