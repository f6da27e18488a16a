import pytest

from folioflow.functions.unit_grammar import PREFIXES, ROOTS, common_amount, learned_prior, parse_number, segment, stated_dimension
from folioflow.operators.units import common_units, metric_profiles

CASES = [
    (("2,265", None, "Total assets", "Footnote 38, figures in US$ MM", "x"), ("USD", 2265000000)),
    (("297,6", "EUR'000", "Net income", "Table 31", "x"), ("EUR", 297600)),
    (("CAD 577.9 million", "%", "Net income", "Slide 39", "x"), ("CAD", 577900000)),
    (("C$ 766.0", "MM", "Operating costs", "x", "x"), ("CAD", 766000000)),
    (("−169’414", "MM U.S.$", "Risk-weighted assets", "x", "x"), ("USD", -169414000000)),
    (("(343)", None, "Liquidity coverage ratio", "Sheet row 1, amounts in per mille", "x"), ("ppm", -343000)),
    (("63.1 bps (+37 bps QoQ)", "bps", "CET1 ratio", "x", "x"), ("ppm", 6310)),
    (("(9) bps (-9 bps QoQ)", None, "CET1 ratio", "x", "x"), ("ppm", -900)),
    (("– 0.465 decimal", "", "Payout ratio", "x", "x"), ("ppm", -465000)),
    (("11 850,5", None, "Total deposits", "x", "All figures are given in € k."), ("EUR", 11850500)),
    (("3.513,2 euro, M", None, "Total assets", "x", "x"), ("EUR", 3513200000)),
    (("3.13", "thousand units", "Employees (FTE)", "x", "x"), ("each", 3130)),
    (("298", None, "Employees (FTE)", "x", "All figures are given in thousand."), ("each", 298000)),
    (("9.75yrs", None, "Contract duration", "x", "x"), ("month", 117)),
    (("21", "quarters", "Repricing gap", "x", "x"), ("month", 63)),
    (("5", None, "Repricing gap [m]", "x", "x"), ("month", 5)),
    (("5", "m $", "Total assets", "x", "x"), ("CAD", 5000000)),
    (("CAD1 B", "", "Gross impaired loans", "x", "x"), ("CAD", 10**9)),
    (("1.2", None, "Total assets – pounds sterling, tn", "x", "x"), ("GBP", 1200000000000)),
    (("10–13", "percent", "CET1 ratio", "x", "x"), None),
    (("see note 7", "$MM", "Total assets", "x", "x"), None),
    (("n.m.", "%", "CET1 ratio", "x", "x"), None),
    (("5,316.8", "-", "Net interest margin", "Table 23", "x was reported for Capital Markets."), None),
    (("", "%", "CET1 ratio", None, None), None),
    ((None, "%", "CET1 ratio", None, None), None),
    (("99999999999999999999", "$", "Total assets", None, None), None),
]


@pytest.mark.parametrize("fields,want", CASES)
def test_common_amount(fields, want):
    assert common_amount(*fields) == want


def test_numbers():
    for text, want in (("1,234", "1234"), ("0,234", "0.234"), ("12,34", "12.34"), ("1.234.567", "1234567"), ("1’234.5", "1234.5"), ("1.5", "1.5"), ("12 34", None), ("1,23,456", None)):
        assert (None if (n := parse_number(text)) is None else str(n)) == want


def test_ambiguous_letters_follow_the_field():
    assert segment("m", "duration").root[0] == "month"
    assert segment("m", "money").scale == 6
    assert segment("mm cad", "money") == segment("cadmm", "money")
    assert segment("tables", None) is None


def test_operator_edges(spark):
    schema = "finding_id bigint, metric_value string, unit string, metric_name string, location_detail string, finding string, common_unit int"
    big = 2**60 + 1
    rows = [(big, "5", "%", "CET1 ratio", None, None, 1), (None, "5", "%", None, None, None, 1), (3, None, None, None, None, None, 1), (3, "5", "%", "x" * 100_000, "", "", 2), (3, "5", "%", "x", "", "", 2)]
    got = common_units(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted([(str(big), "ppm", 50000), ("None", "ppm", 50000), ("3", "ppm", 50000), ("3", "ppm", 50000)])
    assert common_units(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize(
    "fields,want",
    [
        (("12", None, "Total deposits", "Table 4", "Deposits rose to CAD 12 million in 2025."), ("CAD", 12000000)),
        (("12", None, "Total deposits", "Amounts in CAD millions, except per share", "x"), ("CAD", 12000000)),
        (("12", None, "CET1 ratio", "x", "It was 12 % after 11 bps of growth"), ("ppm", 120000)),
        (("12", None, "Total deposits", "x", "Deposits rose from USD 11 million to 12"), None),
        (("12", None, "Total deposits", "x", "Amounts in migration, except per share"), None),
    ],
)
def test_units_beside_the_value_and_before_more_text(fields, want):
    assert common_amount(*fields) == want


SCHEMA = "finding_id bigint, metric_value string, unit string, metric_name string, location_detail string, finding string"


def test_a_bracket_that_belongs_to_a_name_states_no_unit(spark):
    """Learned from the table: nearly all names of the metric have it, also where the unit stands elsewhere."""
    rows = [(i, "298", u, "Employees (FTE)", "Table 1", "Employees moved because of migration.") for i, u in enumerate([None, "thousand", "#", "employees", None])]
    rows += [(9, "5", None, "Employees (FTE) (FTE)", "x", "x"), (10, "7", "", "Digital clients [users]", "x", "x"), (11, "7", "users", "Digital clients", "x", "x"), (12, "7", "k", "Digital clients", "x", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["finding_id"]: r["amount"] for r in common_units(df).collect()}
    assert got == {1: 298000, 2: 298, 3: 298, 9: 5, 10: 7, 11: 7, 12: 7000}
    own = {r["head"]: r["own"] for r in metric_profiles(df).collect()}
    assert own == {"employees": "(FTE)", "digital clients": None}


def test_likelihoods_are_learned_from_the_units_that_a_table_states(spark):
    rows = [(i, "3", u, "Widget spread", "x", "x") for i, u in enumerate(["months", "years", "quarters", "months", "m"])]
    rows += [(10 + i, "3", u, "Gadget spread", "x", "x") for i, u in enumerate(["USD", "EUR", "USD bn", "$MM", "m"])]
    got = {r["finding_id"]: (r["common_unit"], r["amount"]) for r in common_units(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[4] == ("month", 3) and 14 not in got and got[12] == ("USD", 3_000_000_000)
    assert learned_prior("Widget spread", (0, 0, 0, 98)) == (0.01, 0.01, 0.01, 0.98)
    assert [stated_dimension(u) for u in ("USD bn", "%", "m", "", None, "months")] == ["money", "ratio", None, None, None, "duration"]


def test_unit_strings_that_no_fixture_has():
    """Every currency with every scale in nine forms of writing, most of which stand in no test table."""
    forms = ("{c} {s}", "{s} {c}", "in {s} of {c}", "{c}, {s}", "{c} ({s})", "({c} {s})", "{s}, {c}", "as {c} {s}", "[{s} {c}]")
    right = total = 0
    for (unit, dimension, _), names in ROOTS.items():
        for name in names if dimension == "money" else ():
            for power, scales in PREFIXES.items():
                for scale in scales:
                    for form in forms:
                        read = segment(form.format(c=name, s=scale), "money")
                        total += 1
                        right += read is not None and read.root is not None and (read.root[0], read.scale) == (unit, power)
    assert total > 8000 and right / total > 0.99
