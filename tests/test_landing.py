import contextlib
import csv
import os
import random

import pytest

from tributary.contracts import Contract, ContractError
from tributary.functions.payload import CORRUPT
from tributary.operators import StatsSpec
from tributary.plans import bronze_to_silver, land_new_files, landing_to_bronze, medallion, run_medallion
from tributary.plans.medallion import read_bronze
from tributary.sources import read_landed, read_zone
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

CONTRACT = Contract(
    "people",
    StructType(
        [
            StructField("athlete_id", IntegerType()),
            StructField("name", StringType()),
            StructField("height", StringType()),
        ]
    ),
    required=("athlete_id",),
)

GOOD = [
    '1,"last, first",180',
    '2,"said ""hi""",nan',
    "3,,77-80",
]
BROKEN = ['4,"two\nlines",170']
BAD = ["bad,B,1", "5,short", "6,long,1,2"]


def land(folder, name, lines, header="athlete_id,name,height"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        file.write("\n".join([header, *lines]) + "\n")
    return folder


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


WANT_GOOD = [(1, "last, first", "180"), (2, 'said "hi"', "nan"), (3, None, "77-80")]


@contextlib.contextmanager
def splits_of(spark, size):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, old)


SIZES = [128 * 2**20, 1000, 7]


@pytest.mark.parametrize("size", SIZES)
def test_every_kind_of_record(spark, folder, size):
    path = land(folder("in"), "a.csv", GOOD + BROKEN + BAD)
    with splits_of(spark, size):
        rows = read_landed(spark, path, CONTRACT).cache()
        good = rows.filter(f"{CORRUPT} is null").drop(CORRUPT)
        assert table(good) == sorted([*WANT_GOOD, (4, "two\nlines", "170")], key=repr)
        assert sorted(r[CORRUPT] for r in rows.filter(f"{CORRUPT} is not null").collect()) == sorted(BAD)
        rows.unpersist()


@pytest.mark.parametrize("size", SIZES)
def test_columns_are_found_by_name(spark, folder, size):
    path = land(folder("in"), "a.csv", ["x,180,1,more"], header="Name,height,ATHLETE_ID,extra")
    with splits_of(spark, size):
        rows = read_landed(spark, path, CONTRACT, corrupt=None)
        assert rows.dtypes == [("name", "string"), ("height", "string"), ("athlete_id", "int"), ("extra", "string")]
        assert table(rows) == [("x", "180", 1, "more")]


def test_a_required_column_must_be_there(spark, folder):
    path = land(folder("in"), "a.csv", ["x"], header="name")
    with pytest.raises(ContractError):
        read_landed(spark, path, CONTRACT)


@pytest.mark.parametrize("size", SIZES)
def test_files_with_another_header_are_refused(spark, folder, size):
    path = land(folder("in"), "a.csv", GOOD)
    land(path, "b.csv", ["x,1,2"], header="name,athlete_id,height")
    with splits_of(spark, size), pytest.raises(Exception, match="[Hh]eader"):
        read_landed(spark, path, CONTRACT).collect()


STRAY = ['1,5" pipe,180', '2,a "quoted" word,170', '3, "not open,165', '4,"closed" and more,160', "   ", "", '5,"""",1', '6,"a""",""', '7,"x" ,2', '8,",",3', '9,"a\r\nb",4']
WANT_STRAY = [(1, '5" pipe', "180"), (2, 'a "quoted" word', "170"), (3, ' "not open', "165"), (5, '"', "1"), (6, 'a"', None), (8, ",", "3"), (9, "a\r\nb", "4")]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("size", SIZES)
def test_stray_quotes_blank_lines_and_line_ends(spark, folder, size, ending):
    os.makedirs(folder("in"))
    with open(folder("in") + "/a.csv", "w", newline="", encoding="utf-8") as file:
        file.write(ending.join(["athlete_id,name,height", *STRAY]) + ending)
    with splits_of(spark, size):
        rows = read_landed(spark, folder("in"), CONTRACT).collect()
    assert len(rows) == 9 and all(r[CORRUPT] is None for r in rows)
    # Breaks in a cell become the file's own, and these a single one.
    want = {tuple("a\nb" if cell == "a\r\nb" and ending == "\r\n" else cell for cell in row) for row in WANT_STRAY}
    assert want <= {tuple(r)[:3] for r in rows}


def test_records_over_many_lines(spark, folder):
    """Random texts, in files much larger than a split; one record is longer than several of these."""
    rnd = random.Random(3)
    pieces = ["a", "bc", ",", '"', "\n", "é", " ", '""', "\n\n", "x" * 30, "\\"]
    want = []
    os.makedirs(folder("in"))
    for number, ending in enumerate(["\n", "\r\n", "\n"]):
        with open(folder("in") + f"/{number}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, lineterminator=ending)
            writer.writerow(CONTRACT.schema.names)
            for i in range(300):
                cells = ["".join(rnd.choices(pieces, k=rnd.randint(1, 8))) for _ in range(2)]
                if i == 150:
                    cells[0] = "line\n" * 1500
                want.append((len(want), *cells))
                writer.writerow(want[-1])
    for size in (1000, 2**27):
        with splits_of(spark, size):
            assert (spark.read.text(folder("in")).rdd.getNumPartitions() > 20) == (size == 1000)
            assert table(read_landed(spark, folder("in"), CONTRACT, corrupt=None)) == sorted(want, key=repr)


def test_large_files_of_one_line_records_are_split(spark, folder):
    many = land(folder("many"), "a.csv", [f'{i},"a, ""{i}""",180' for i in range(20_000)] + ["   ", "bad,x,1"])
    contract = Contract(CONTRACT.name, CONTRACT.schema, CONTRACT.required, one_line=True)
    with splits_of(spark, 65536):
        split = read_landed(spark, many, contract, corrupt=None)
        assert split.rdd.getNumPartitions() > 4
        assert split.where("athlete_id is not null").distinct().count() == 20_000
        assert split.filter("name = concat('a, \"', athlete_id, '\"')").count() == 20_000
        assert [r for r in table(read_landed(spark, many, contract)) if r[3]] == [(None, "x", "1", "bad,x,1")]
        assert read_landed(spark, many, CONTRACT).rdd.getNumPartitions() == 1
        assert read_landed(spark, many, CONTRACT).count() == split.count() == 20_001


def test_bronze_keeps_rejected_rows_aside(spark, folder):
    landed = {"people": land(folder("in"), "a.csv", GOOD + BROKEN + BAD)}
    counts = landing_to_bronze(spark, landed, folder("bronze"), [CONTRACT])
    assert counts == {"people": {"rows": 7, "rejected": 3}}
    assert read_bronze(spark, folder("bronze"), "people", with_rejected=False).count() == 4
    whole = read_bronze(spark, folder("bronze"), "people")
    assert whole.count() == 7 and whole.columns == CONTRACT.schema.names
    assert read_zone(spark, folder("bronze"), "people").filter("rejected = 'true'").select(CORRUPT).distinct().count() == 3

    left_out = bronze_to_silver(
        spark, folder("bronze"), folder("silver"), ["people"], with_rejected=False, preview_rows=2
    )
    assert left_out == {"people": 3}
    silver = read_zone(spark, folder("silver"), "people", CONTRACT)
    assert silver.count() == 4
    assert bronze_to_silver(spark, folder("bronze"), folder("silver"), ["people"]) == {"people": 0}
    assert read_zone(spark, folder("silver"), "people").count() == 7


def test_bronze_without_any_reject(spark, folder):
    landed = {"people": land(folder("in"), "a.csv", GOOD)}
    assert landing_to_bronze(spark, landed, folder("bronze"), [CONTRACT]) == {"people": {"rows": 3, "rejected": 0}}
    assert read_bronze(spark, folder("bronze"), "people").count() == 3


def test_a_broken_step_ends_the_run(spark, folder):
    from tributary.plans import run_medallion

    landed = {"people": land(folder("in"), "a.csv", ["x"], header="name")}
    with pytest.raises(ContractError):
        run_medallion(spark, landed, folder("lake"), [CONTRACT])
    assert not os.path.exists(folder("lake"))


def test_a_table_without_rows(spark, folder):
    landed = {"people": land(folder("in"), "a.csv", [])}
    assert landing_to_bronze(spark, landed, folder("bronze"), [CONTRACT]) == {"people": {"rows": 0, "rejected": 0}}
    bronze_to_silver(spark, folder("bronze"), folder("silver"), ["people"])
    assert read_zone(spark, folder("silver"), "people", CONTRACT).count() == 0


def test_a_table_of_rejected_rows_only(spark, folder):
    landed = {"people": land(folder("in"), "a.csv", BAD)}
    assert landing_to_bronze(spark, landed, folder("bronze"), [CONTRACT]) == {"people": {"rows": 3, "rejected": 3}}
    bronze_to_silver(spark, folder("bronze"), folder("silver"), ["people"], with_rejected=False)
    assert read_zone(spark, folder("silver"), "people", CONTRACT).count() == 0


FACTS = Contract("facts", StructType([StructField("athlete_id", IntegerType()), StructField("sport", StringType())]), ("athlete_id",))
SPEC = StatsSpec(on=("athlete_id",), group_by=("sport",), measures={"avg_height": "height"}, stamp=None)


def test_a_run_that_failed_goes_on_where_it_ended(spark, folder, monkeypatch):
    landed = {"people": land(folder("in"), "a.csv", GOOD), "facts": land(folder("facts"), "f.csv", ["1,row", "2,row"], "athlete_id,sport")}
    scans = []
    monkeypatch.setattr(medallion, "read_landed", lambda spark, path, contract: scans.append(contract.name) or read_landed(spark, path, contract))
    silvers = []
    monkeypatch.setattr(medallion, "bronze_to_silver", lambda *a, **k: silvers.append(1) or bronze_to_silver(*a, **k))
    options = {"contracts": [CONTRACT, FACTS], "resume": True, "facts": "facts", "dimension": "people"}
    with pytest.raises(Exception, match="no_such"):
        run_medallion(spark, landed, folder("lake"), **options, spec=SPEC.with_(group_by=("no_such",)))
    assert scans == ["people", "facts"] and silvers == [1]
    path = run_medallion(spark, landed, folder("lake"), **options, spec=SPEC)
    assert scans == ["people", "facts"] and silvers == [1]
    assert spark.read.parquet(path).count() == 1 == read_zone(spark, folder("lake/gold"), "avg_stats").count()
    assert run_medallion(spark, landed, folder("lake"), **options, spec=SPEC) == path
    land(folder("facts"), "g.csv", ["3,swim"], "athlete_id,sport")
    later = run_medallion(spark, landed, folder("lake"), **options, spec=SPEC)
    assert len(scans) == 4 and silvers == [1, 1] and later != path and spark.read.parquet(later).count() == 2
    run_medallion(spark, landed, folder("lake"), **(options | {"resume": False}), spec=SPEC)
    assert len(scans) == 6


def test_only_what_newly_landed_is_read(spark, folder):
    landed = {"people": land(folder("in"), "a.csv", GOOD + BROKEN)}

    def run():
        return land_new_files(spark, landed, folder("bronze"), [CONTRACT], checkpoints=folder("progress"))["people"]

    assert run() == {"rows": 4, "rejected": 0}
    assert run() == {"rows": 0, "rejected": 0}
    land(folder("in"), "b.csv", ["8,new,1", *BAD])
    assert run() == {"rows": 4, "rejected": 3}
    assert read_bronze(spark, folder("bronze"), "people").count() == 8
    good = read_bronze(spark, folder("bronze"), "people", with_rejected=False)
    assert sorted(r[0] for r in good.collect()) == [1, 2, 3, 4, 8] and good.columns == CONTRACT.schema.names
    landing_to_bronze(spark, landed, folder("whole"), [CONTRACT])
    with pytest.raises(ValueError, match="as a whole"):
        land_new_files(spark, landed, folder("whole"), [CONTRACT], checkpoints=folder("other"))
