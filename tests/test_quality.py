import pytest

from surveyloom.operators import quality, shape, shares
from surveyloom.plans import silver
from surveyloom.plans import vocabulary as v


def test_absent_column_stops_the_edition(spark):
    df = spark.createDataFrame([("a", "b")], "`1.b_genero` string, outro string")
    silver.mapped_edition(df, {"genero": "1.b_genero"}, 2025)
    with pytest.raises(quality.QualityError, match="lang_r <- 4.c.2_R"):
        silver.mapped_edition(df, {"genero": "1.b_genero", "lang_r": "4.c.2_R"}, 2025)


def test_headers_are_taken_literally(spark):
    odd = ["('P4_d_2 ', 'R ')", "4.c.2_R", "a`b", "fim "]
    df = spark.createDataFrame([("1", "2", "3", "4")], odd)
    got = silver.mapped_select(df, {f"t{i}": h for i, h in enumerate(odd)}).first()
    assert got.asDict() == {"t0": "1", "t1": "2", "t2": "3", "t3": "4"}


def test_row_volume_gate(spark):
    counts = spark.createDataFrame([(2023, 5293), (2024, 5216), (2030, 1)], "edition int, n long")
    wanted = spark.createDataFrame([(2023, 5293), (2024, 5217), (2025, 3495)], "edition int, expected long")
    gate = quality.volume_gate(counts, wanted)
    assert {r["edition"]: r["status"] for r in gate.collect()} == {
        2023: "OK", 2024: "DIVERGENTE", 2025: "DIVERGENTE", 2030: "DIVERGENTE"}
    with pytest.raises(quality.QualityError, match="2024"):
        quality.require_volumes(gate)
    quality.require_volumes(gate.filter("edition = 2023"))


def test_union_is_strict(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(1, 2)], "x int, y int")
    with pytest.raises(Exception, match="NUM_COLUMNS_MISMATCH|number of columns"):
        silver.union_editions([a, b]).collect()


def test_unasked_option_gives_no_row(spark):
    rows = [(2023, 1, None), (2023, 0, None), (2024, None, 1), (2024, 1, 0)]
    df = spark.createDataFrame(rows, "ano int, a int, b int")
    got = shares.multi_response(df, {"a": "Opção d'água", "b": "B"}, "opcao")
    assert sorted(tuple(r) for r in got.collect()) == [
        (2023, "Opção d'água", 1, 2, 50.0), (2024, "B", 1, 2, 50.0), (2024, "Opção d'água", 1, 1, 100.0)]


def test_densify_shows_null_for_new_categories(spark):
    rows = [(2024, "Pleno", 40.0), (2025, "Especialista/Staff+", 9.0)]
    df = spark.createDataFrame(rows, "ano int, nivel string, pct double")
    got = shape.densify(df, ["ano"], "nivel", v.LEVELS, ["pct"]).orderBy("ano", "ordem").collect()
    assert [r["pct"] for r in got] == [None, 40.0, None, None, None, None, None, 9.0]


def test_tied_values_share_the_mark(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (1, "c", 5), (1, "d", 1)], "ano int, k string, n int")
    got = {r["k"]: r["destaque"] for r in shape.flag_top_values(df, ["ano"], "n", 2, "destaque").collect()}
    assert got == {"a": 1, "b": 1, "c": 1, "d": 0}


def test_marks_of_null_groups_and_measures(spark):
    df = spark.createDataFrame([(None, 5), (None, 4), (None, None), (1, None), (2, 3)], "ano int, n int")
    got = shape.flag_top_values(df, ["ano"], "n", 1, "destaque")
    assert got.columns == ["ano", "n", "destaque"]
    assert {(r["ano"], r["n"]): r["destaque"] for r in got.collect()} == {
        (None, 5): 1, (None, 4): 0, (None, None): None, (1, None): None, (2, 3): 1}


def test_shares_of_null_groups_and_of_all_rows(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), (None, "b"), (1, "a"), (1, None)], "g int, k string")
    got = {(r["g"], r["k"]): (r["n"], r["pct"]) for r in shares.distribution(df, "k", ["g"]).collect()}
    assert got == {(None, "a"): (2, 50.0), (None, "b"): (2, 50.0), (1, "a"): (1, 100.0)}
    assert {r["k"]: r["pct"] for r in shares.distribution(df, "k", []).collect()} == {"a": 60.0, "b": 40.0}


def test_ties_in_a_ranking_are_stable(spark):
    df = spark.createDataFrame([(1, k, 106) for k in "dbca"], "ano int, k string, n int")
    for parts in (1, 4):
        top = shape.top_per_group(df.repartition(parts), ["ano"], "n", ["k"], 2)
        assert sorted(r["k"] for r in top.collect()) == ["a", "b"]


def test_checksum_ignores_order_but_not_content(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(50)], "a int, b string")
    one = quality.content_checksum(df, ["a", "b"]).first()
    assert quality.content_checksum(df.repartition(7).orderBy("b"), ["a", "b"]).first() == one
    assert quality.content_checksum(df.replace("r7", "r8", ["b"]), ["a", "b"]).first() != one
    assert quality.content_checksum(df.union(df), ["a", "b"]).first() != one


def test_checksum_tells_fields_apart(spark):
    def digest(*row):
        return quality.content_checksum(spark.createDataFrame([row], "a string, b string"), ["a", "b"]).first()["checksum"]

    pairs = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("~", "c"), ("N", "c"), ("", "c"), ("1:a", ""), ("", "1:a")]
    assert len({digest(*p) for p in pairs}) == len(pairs)
