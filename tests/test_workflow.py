"""The whole load, check and publish story on small CSV files, in three variants.

The files are made by rule with the row counts that the expected numbers follow
from; one variant skips the header line, two take it in as a row.
"""

from __future__ import annotations

import csv

import pytest

from branchyard import BranchStore, UnknownRef, UnknownTable
from branchyard.operators import audit
from branchyard.sources import csv_with_header, csv_without_header, temp_view

STATS = [f"S{i} STRING" for i in range(1, 9)]
PAY = "Season STRING, Team STRING, Pay STRING, Player STRING"
TOTALS = ", ".join(["Season STRING", "Age STRING", "Team STRING", *STATS, "Player STRING", "Part STRING"])
GUESTS = ", ".join(["Season STRING", "Age STRING", "Team STRING", *STATS, "Player STRING"])

# fixed values: the rows of each file, from which all expected counts follow
FILES = {"pay": (PAY, 50), "totals": (TOTALS, 92), "guests": (GUESTS, 47)}

FOUR_ROWS = [(f"{year}-{year % 100 + 1}", "Some Team", f"${year}000", "Some Player") for year in range(2017, 2021)]


def names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    for name, (schema, n_rows) in FILES.items():
        columns = names(schema)
        with open(folder / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(columns)
            for i in range(n_rows):
                # every tenth row has empty statistics, as real files do
                row = [f"{c}{i}" if c in ("Season", "Player") or i % 10 else "" for c in columns]
                writer.writerow(row)
    return folder


def counts(store: BranchStore, ref: str) -> dict[str, int]:
    return {row["table"]: row["n_rows"] for row in audit.count_rows(store, [ref]).collect()}


@pytest.fixture(scope="module")
def with_header(spark, files, tmp_path_factory):
    store = BranchStore.start(spark, str(tmp_path_factory.mktemp("header")))
    seen = {}

    def view(name):
        return temp_view(csv_with_header(spark, str(files / f"{name}.csv")), f"{name}_file")

    store.create_namespace("league")
    seen["created"] = store.create_ref("dev").toPandas()
    seen["heads at first"] = {r["name"]: r["hash"] for r in store.list_refs().collect()}
    dev = store.at("dev")
    for name in ("pay", "totals"):
        dev.create_table(f"league.{name}", FILES[name][0])
        seen["insert"] = dev.append(f"league.{name}", view(name)).toPandas()
        audit.require_reconciled(store.table(f"league.{name}@dev"), spark.table(f"{name}_file"))
    seen["main before"], seen["dev before"] = store.at("main").table_keys(), dev.table_keys()
    seen["heads before"] = {r["name"]: r["hash"] for r in store.list_refs().collect()}
    store.merge_ref("dev")
    seen["heads after"] = {r["name"]: r["hash"] for r in store.list_refs().collect()}
    seen["main after dev"] = counts(store, "main")

    store.create_ref("etl")
    etl = store.at("etl")
    etl.append_values("league.pay", FOUR_ROWS)
    etl.drop_column("league.totals", "Age")
    etl.create_table("league.guests", GUESTS)
    etl.append("league.guests", view("guests"))
    seen["main during etl"], seen["etl"] = counts(store, "main"), counts(store, "etl")
    store.merge_ref("etl")
    seen["main after etl"] = counts(store, "main")

    store.create_ref("experiment")
    experiment = store.at("experiment")
    experiment.drop_table("league.totals")
    experiment.append_values("league.pay", FOUR_ROWS)
    return store, seen


def test_goldens_with_header(with_header):
    store, seen = with_header
    assert seen["main after dev"] == {"league.pay": 50, "league.totals": 92}
    assert seen["main during etl"] == seen["main after dev"]
    assert seen["main after etl"] == {
        "league.pay": 54, "league.totals": 92, "league.guests": 47,
    }
    assert seen["etl"] == seen["main after etl"]
    assert counts(store, "main") == seen["main after etl"]
    assert counts(store, "experiment") == {"league.pay": 58, "league.guests": 47}


def test_sql_count_prints_like_an_engine(spark, with_header):
    store, _ = with_header
    store.at("experiment").create_views(current=False)
    store.at("main").create_views()
    on_experiment = spark.sql("select count(*) from `pay@experiment`").toPandas()
    assert str(on_experiment) == "   count(1)\n0        58"
    on_main = spark.sql("select count(*) from pay").toPandas()
    assert str(on_main) == "   count(1)\n0        54"


def test_insert_returns_an_empty_frame(with_header):
    assert str(with_header[1]["insert"]) == "Empty DataFrame\nColumns: []\nIndex: []"


def test_refs_are_listed_with_their_heads(with_header):
    store, seen = with_header
    created = seen["created"]
    assert list(created["ref_type"]) == ["Branch"] and list(created["name"]) == ["dev"]
    at_first = seen["heads at first"]
    assert at_first["main"] == at_first["dev"] == created["hash"][0]
    assert seen["heads before"]["main"] != seen["heads before"]["dev"]
    assert seen["heads after"]["main"] == seen["heads after"]["dev"]
    listed = store.list_refs().toPandas()
    assert set(listed["name"]) == {"main", "dev", "etl", "experiment"}
    assert set(listed["ref_type"]) == {"Branch"}


def test_main_is_isolated_until_the_merge(with_header):
    _, seen = with_header
    assert seen["main before"] == []
    assert seen["dev before"] == ["league.pay", "league.totals"]


def test_dropped_column_is_gone_on_merged_refs_only(with_header):
    store, _ = with_header
    assert store.table("league.totals@dev").columns == names(TOTALS)
    assert store.table("league.totals").columns == [n for n in names(TOTALS) if n != "Age"]
    changes = {r["column"]: (r["type_main"], r["type_dev"]) for r in
               audit.schema_diff(store, "league.totals", "main", "dev").collect()}
    assert changes["Age"] == (None, "string") and changes["S8"] == ("string", "string")


def test_empty_fields_are_null(with_header):
    rows = with_header[0].table("league.guests")
    row = rows.selectExpr("count(*) AS n", "count(S1) AS orb", "count(Season) AS season").first()
    assert (row["n"], row["orb"], row["season"]) == (47, 42, 47)


def test_goldens_with_the_header_as_a_row(spark, files, tmp_path):
    """As a table environment with a declared schema reads the files; a rename instead of a column drop."""
    store = BranchStore.start(spark, str(tmp_path))
    store.create_namespace("league")
    raw = {name: csv_without_header(spark, str(files / f"{name}.csv"), schema) for name, (schema, _) in FILES.items()}
    store.create_ref("dev")
    for name in ("pay", "totals"):
        store.at("dev").create_table(f"league.{name}", FILES[name][0])
        store.at("dev").append(f"league.{name}", raw[name])
        audit.require_reconciled(store.table(f"league.{name}@dev").select("Season"), raw[name].select("Season"))
    store.merge_ref("dev")
    store.create_ref("etl")
    etl = store.at("etl")
    etl.append_values("league.pay", FOUR_ROWS)
    etl.rename_table("league.totals", "league.new_totals")
    etl.create_table("league.guests", GUESTS)
    etl.append("league.guests", raw["guests"])
    store.merge_ref("etl")
    store.create_ref("experiment")
    store.at("experiment").drop_table("league.new_totals")
    store.at("experiment").append_values("league.pay", FOUR_ROWS)
    assert counts(store, "main") == {
        "league.pay": 55, "league.new_totals": 93, "league.guests": 48,
    }
    assert counts(store, "experiment") == {"league.pay": 59, "league.guests": 48}


def test_goldens_through_staging(spark, files, tmp_path):
    """Text files go into staging tables, which every ref sees, and from there replace the tables."""
    store = BranchStore.start(spark, str(tmp_path))
    store.create_namespace("league")
    store.create_ref("dev")
    for name in ("pay", "totals"):
        schema = FILES[name][0]
        store.at("dev").create_table(f"league.{name}", schema)
        for _ in range(2):
            store.load_staging(f"{name}_temp", csv_without_header(spark, str(files / f"{name}.csv"), schema))
        store.at("dev").overwrite(f"league.{name}", store.staging(f"{name}_temp"))
    store.merge_ref("dev")
    assert audit.require_reconciled(store.table("league.pay"), store.staging("pay_temp")) == 51
    store.create_ref("etl")
    store.at("etl").append_values("league.pay", FOUR_ROWS)
    store.merge_ref("etl")
    store.create_ref("experiment")
    store.at("experiment").append_values("league.pay", FOUR_ROWS)
    store.at("main").append_values("league.pay", FOUR_ROWS[:1])
    assert counts(store, "experiment")["league.pay"] == 59
    assert counts(store, "main")["league.pay"] == 56
    for ref in ("dev", "etl", "experiment"):
        store.drop_ref(ref)
    assert [r["name"] for r in store.list_refs().collect()] == ["main"]
    assert counts(store, "main")["league.pay"] == 56


def test_unknown_names(with_header):
    store, _ = with_header
    with pytest.raises(UnknownRef):
        store.table("league.pay@nowhere")
    with pytest.raises(UnknownTable):
        store.table("league.nothing")
    with pytest.raises(UnknownTable):
        store.table("league.totals@experiment")
