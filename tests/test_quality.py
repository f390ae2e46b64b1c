from riskloom.operators import quality


def test_null_counts_and_duplicates(rows):
    df = rows([(1, None), (1, None), (2, "x"), (1, None)], "a int, b string")
    assert quality.null_counts(df).first().asDict() == {"a": 0, "b": 3}
    assert quality.duplicate_rows(df).first().asDict() == {"row_count": 4, "distinct_count": 2, "duplicate_count": 2}
    assert quality.duplicate_rows(df.limit(0)).first()["duplicate_count"] == 0


def test_amount_validity(rows):
    df = rows([(-1.0,), (0.0,), (0.0,), (3.0,), (None,)], "amount double")
    assert quality.amount_validity(df).first().asDict() == {"row_count": 5, "negative_amounts": 1, "zero_amounts": 2}


def test_label_distribution(rows):
    df = rows([(0,), (0,), (1,)], "isFraud int")
    assert [tuple(r) for r in quality.label_distribution(df).collect()] == [(0, 2, 66.6667), (1, 1, 33.3333)]


def test_key_check(rows):
    def verdict(values):
        return quality.key_check(rows([(v,) for v in values], "k int"), "k").first()["is_primary_key"]

    assert verdict([1, 2, 3])
    assert not verdict([1, 1, 2])
    assert not verdict([1, None])


def test_table_check_of_an_empty_table(rows):
    got = quality.table_check(rows([], "isFraud int, a int")).first().asDict()
    assert got == {"row_count": 0, "fraud_count": 0, "fraud_percentage": None, "column_count": 2}


def test_profile_matches_the_single_reports(rows):
    data = [("A", 0, 1.0, "C1", "M1"), ("A", 1, -2.0, "C2", "C1"), ("B", 0, 0.0, "C1", "M2"), ("B", 0, None, "M1", "M2")]
    df = rows(data, "type string, isFraud int, amount double, nameOrig string, nameDest string")
    report = {
        (r["report"], r["type"], r["isFraud"], r["orig_type"], r["dest_type"]): r
        for r in quality.profile_reports(quality.profile_cells(df)).collect()
    }
    for r in quality.amount_by_type(df).collect():
        cell = report[("type", r["type"], None, None, None)]
        assert (cell["row_count"], cell["avg_amount"], cell["max_amount"]) == tuple(r)[1:]
    total = report[("all", None, None, None, None)]
    assert (total["row_count"], total["negative_amounts"], total["zero_amounts"]) == (4, 1, 1)
