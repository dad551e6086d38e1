import pytest

from tillroll.operators import rules
from tillroll.schema import RULE_NAMES, SOURCE_COLUMNS
from tillroll.sources.transactions import header_errors

BREAKS = {
    "null_invoice_no": {"invoice_no": None},
    "invalid_invoice_no_prefix": {"invoice_no": "A1"},
    "null_customer_id": {"customer_id": None},
    "invalid_customer_id_prefix": {"customer_id": "77"},
    "invalid_gender": {"gender": "female"},
    "invalid_age": {"age": "121"},
    "invalid_category": {"category": "Garden"},
    "invalid_quantity": {"quantity": "0"},
    "invalid_price": {"price": "-3"},
    "invalid_payment_method": {"payment_method": "Voucher"},
    "invalid_invoice_date": {"invoice_date": "2022-03-07"},
    "invalid_shopping_mall": {"shopping_mall": "Harbour Arcade"},
}


def errors(feed, *rows):
    return [r._errors for r in rules.check_rows(feed(*rows)).orderBy("_row_id").collect()]


def test_header():
    assert header_errors(SOURCE_COLUMNS) == []
    assert header_errors(SOURCE_COLUMNS[:9]) == [
        "expected_10_columns_got_9",
        "column_names_mismatch",
    ]
    assert len(header_errors([*SOURCE_COLUMNS, "extra"])) == 2
    assert header_errors(SOURCE_COLUMNS[::-1]) == ["column_names_mismatch"]


def test_good_rows_pass(feed):
    report = rules.validate(feed({}, {"age": "1"}, {"age": "120", "invoice_date": "25/12/2021"}))
    assert report["schema_valid"]
    assert (report["total_rows"], report["valid_rows"], report["invalid_rows"]) == (3, 3, 0)
    assert set(report["error_summary"]) == set(RULE_NAMES)
    assert not any(report["error_summary"].values())


def test_each_rule_alone(feed):
    assert list(BREAKS) == RULE_NAMES
    assert errors(feed, *BREAKS.values()) == RULE_NAMES


def test_one_row_can_break_many_rules(feed):
    everything = {}
    for change in list(BREAKS.values())[1:]:
        everything = {**change, **everything}
    bad = {"gender": None, "age": "x", "category": "", "quantity": "-1", "payment_method": None}
    summary = {
        r.rule: r.broken_rows for r in rules.error_summary(feed({}, everything, bad)).collect()
    }
    assert summary["invalid_gender"] == 2
    assert summary["invalid_quantity"] == 2
    assert summary["invalid_price"] == 1
    report = rules.validation_report(feed({}, everything, bad)).first()
    assert (report.total_rows, report.valid_rows, report.invalid_rows) == (3, 1, 2)
    assert report.invalid_percent == pytest.approx(200 / 3)


def test_empty_input(spark, feed):
    nothing = feed({}).limit(0)
    report = rules.validate(nothing)
    assert report["total_rows"] == 0 and report["error_summary"] == {}
    assert rules.error_summary(nothing).count() == 0
    assert rules.validation_report(nothing).first().invalid_percent == 0.0


def test_wrong_header_rejects_all(feed):
    rows = feed({}, {})
    report = rules.validate(rows.drop("price"))
    assert not report["schema_valid"]
    assert report["invalid_rows"] == 2 and report["valid_rows"] == 0
    assert report["error_summary"] == {"schema_errors": 2}


def test_padding_is_trimmed_and_blank_is_not_null(feed):
    padded = {"shopping_mall": " Kanyon\t", "gender": " Male ", "invoice_no": " I1 ",
              "price": " 5 ", "invoice_date": " 1/2/2022"}
    assert errors(feed, padded, {"invoice_no": "  "}, {"invoice_no": ""}) == [
        "",
        "invalid_invoice_no_prefix",
        "null_invoice_no",
    ]
    row = rules.valid_rows(rules.check_rows(feed(padded))).first()
    assert (row.invoice_no, row.shopping_mall, row.gender) == ("I1", "Kanyon", "Male")


@pytest.mark.parametrize("blank", ["\u0085", "\u2028", "\n", "\u00a0", " "])
def test_white_space_behind_an_id_is_trimmed(feed, blank):
    checked = rules.check_rows(feed({"customer_id": "C70" + blank, "invoice_no": "I900" + blank}))
    row = rules.valid_rows(checked).first()
    assert (row.customer_id, row.invoice_no) == ("C70", "I900")


@pytest.mark.parametrize("token", ["NA", "nan", "NULL", "None", "N/A", "n/a", "#N/A", "<NA>"])
def test_null_tokens(feed, token):
    assert errors(feed, {"customer_id": token}) == ["null_customer_id"]


def test_number_edges(feed):
    bad = ["NaN", "inf", "-inf", "", "abc", "5d", "0x1p3", "1e999", "99999999999999"]
    for value in bad:
        assert errors(feed, {"quantity": value}) == ["invalid_quantity"], value
        assert errors(feed, {"price": value}) == ["invalid_price"], value
    assert errors(feed, {"quantity": "2.5"}, {"price": "1e2"}, {"age": "25.7"}) == ["", "", ""]
    assert errors(feed, {"age": "0.5"}, {"age": "120.5"}) == ["invalid_age"] * 2
    # Rules hold for the number as written, not as rounded to any column.
    assert errors(feed, {"age": "120.00004"}, {"age": "0.99996"}) == ["invalid_age"] * 2
    assert errors(feed, {"quantity": "0.0000001"}, {"quantity": "1e-20"}) == ["", ""]
    # What no column can hold is a broken rule, not a failed load.
    assert errors(feed, {"quantity": "3000000000"}) == ["invalid_quantity"]
    assert errors(feed, {"price": "99999999.999"}) == ["invalid_price"]
    assert errors(feed, {"quantity": "2147483647", "price": "99999999.99"}) == [""]
    assert rules.valid_rows(rules.check_rows(feed({"age": "25.7"}))).first().age == 25


def test_date_edges(feed):
    bad = ["31/02/2021", "2021-01-02", "5/8/22", "", None, "29/2/2021", "5-8-2022", "5/8/2022 x"]
    assert errors(feed, *[{"invoice_date": d} for d in bad]) == ["invalid_invoice_date"] * len(bad)
    good = rules.check_rows(feed({"invoice_date": "5/8/2022"}, {"invoice_date": "05/08/2022"}))
    assert {str(r._invoice_date) for r in good.collect()} == {"2022-08-05"}


def test_other_date_format(feed):
    rows = feed({"invoice_date": "2021-02-03"}, {"invoice_date": "3/2/2021"})
    found = [r._errors for r in rules.check_rows(rows, "yyyy-MM-dd").collect()]
    assert found == ["", "invalid_invoice_date"]


def test_split_adds_up(feed):
    checked = rules.check_rows(feed({}, *BREAKS.values(), {}))
    valid, rejected = rules.valid_rows(checked), rules.rejected_rows(checked)
    assert (valid.count(), rejected.count()) == (2, 12)
    kept = {r.errors: r for r in rejected.collect()}
    assert kept["invalid_price"].price == "-3"
