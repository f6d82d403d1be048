import random

import pytest

from assaywright import (
    Between, CastsTo, Chain, Compare, IsNull, Like, Matches, OneOf, Param, Rule, Sql, all_of, any_of, if_then,
)
from assaywright.catalog import values as V
from assaywright.catalog.builtin import TEMPLATES, build
from assaywright.plans.table_check import TableCheck

RUN = "2026-01-01 00:00:00"


def flags(pairs):
    return [flag for flag, _ in pairs]


def test_missing_values(flag_of):
    got = flag_of(build("DQ_001", "v"), [None, "", "   ", "null", " NULL ", "\t", "x", "nullable"])
    assert flags(got) == [-1, -1, -1, -1, -1, 0, 0, 0]
    assert got[0][1] == "missing value for fields: v" and got[6][1] == ""


def test_missing_names_every_missing_column(frame):
    df = frame("a string, `b c` string, d int", (None, " ", 1), ("x", None, 2), ("x", "y", 3))
    rule = build("DQ_001", ("a", "b c"))
    rows = TableCheck(df, [], RUN).flags(rule).orderBy("d").collect()
    assert [r["rule_violation_details"] for r in rows] == [
        "missing value for fields: a,b c", "missing value for fields: b c", "",
    ]


CASES = {
    "DQ_002": (["12", " -3.5 ", "0.0"], ["1e5", "1,000", ".5", "5.", "--1"]),
    "DQ_006": (["7"], ["seven"]),
    "DQ_008": (["20200131 10:11:12.123", "2020-01-31 10:11:12.123"], ["2020-01-31 10:11:12", "2020-13-01 10:11:12.123"]),
    "DQ_009": (["20200131", "2020-02-31", "1899-12-01"], ["31-01-2020", "2020/01/31", "1700-01-01", "2020-00-10"]),
    "DQ_010": (["2020-01-31T10:11:12Z", "20200131 10:11:12", "2020013110:11:12"], ["2020-01-31", "2020-01-31T10:11"]),
    "DQ_011": (["a_B-9/x"], ["a b", "é", "a.b"]),
    "DQ_012": (["a.b@x.org", " u+1@mail.co "], ["u@x", "user@mail.info", "no-at.com"]),
    "DQ_013": (["+971 50 123 4567", "0501234567", "00971-4-123-4567", "541234567"], ["12345", "+1 202 555 0100"]),
    "DQ_014": (["male", " FEMALE ", "Mixed", "unknown"], ["M", "females"]),
    "DQ_015": (["Mary-Ann Smith", "a/b.c", "abc\t"], ["Ann3", "a  b", "-a", "a-", "مدرسة"]),
    "DQ_016": (["مدرسة دبي", "(سلام)-"], ["abc", "مدرسة1", "a\\b"]),
    "DQ_017": (["2020/01/31", "20200131", "2020-01-31T10:11:12.123Z", "2020-01-31 "], ["31/01/2020", "2020-01-31T1"]),
    "DQ_018": (["moe", "Al Hosn"], ["Klingon"]),
    "DQ_019": (["AE", "yu", "c", "Unknown", "Other"], ["GL", "ZZ", "WS"]),
    "DQ_020": (["widow"], ["engaged"]),
    "DQ_021": (["Pre Primary -G5", "grade 13"], ["Grade 14"]),
    "whole_number": (["-12"], ["1.5"]),
    "emirate": (["dubai", "Umm al quwain"], ["Fujairah"]),
}


@pytest.mark.parametrize("rule_id", sorted(CASES))
def test_shipped_rule(flag_of, rule_id):
    good, bad = CASES[rule_id]
    got = flag_of(build(rule_id, "v"), [*good, *bad])
    assert flags(got) == [0] * len(good) + [1] * len(bad)
    assert all(text.startswith(("Regex pattern violated in v: ", "Condition violated: v IN (")) for _, text in got[len(good) :])


def test_every_shipped_id_is_there():
    assert {f"DQ_{i:03d}" for i in range(1, 22)} <= set(TEMPLATES)


def test_english_text_on_a_long_text(flag_of):
    long = "word " * 40_000 + "end"
    assert flags(flag_of(build("DQ_015", "v"), [long, long + "1", long.replace("end", "-end")])) == [0, 1, 1]


def test_english_parts_agree_with_the_pattern(frame):
    rng = random.Random(7)
    texts = {"".join(rng.choice("aB-. /\t\n1") for _ in range(rng.randrange(1, 9))) for _ in range(4000)}
    df = frame("v string", *[(t,) for t in sorted(texts)])
    whole, parts = Matches("v", V.ENGLISH_TEXT), Matches("v", V.ENGLISH_TEXT, False, V.ENGLISH_EVERY, V.ENGLISH_NONE)
    from assaywright.functions.predicates import holds

    assert df.where(holds(whole) != holds(parts)).count() == 0
    assert df.where(holds(whole)).count() > 50


CONDITIONS = [
    (Compare("v", "=", " ABC "), ["abc", " Abc"], ["ab"]),
    (Compare("v", ">", 95), ["100", " 95.5 "], ["95", "abc"]),
    (Compare("v", ">", "95"), ["96"], ["100"]),
    (Compare("v", "<", Param("top")), ["4"], ["5", "x"]),
    (Compare("v", "=", Param("word")), ["Yes"], ["no"]),
    (Compare(Sql("length(v)"), ">=", 3), ["abc"], ["ab"]),
    (OneOf("v", ("A", "b ")), ["a", "B"], ["c"]),
    (OneOf("v", ("A",), negate=True), ["c"], ["a"]),
    (Between("v", 1, 5), ["1", "5.0"], ["0.9", "x"]),
    (Between("v", 1, 5, negate=True), ["6"], ["3", "x"]),
    (Like("v", "A%"), ["abc"], ["bac"]),
    (CastsTo("v", "date", negate=True), ["31-01-2020", "2020-02-31"], ["2020-01-31"]),
    (IsNull("n"), [], ["a"]),
    (any_of(Compare("v", "=", "a"), all_of(Compare("v", ">", 1), Compare("v", "<", 3))), ["A", "2"], ["3", "b"]),
    (if_then(Like("v", "a%"), Like("v", "%z")), ["ab"], ["az", "b"]),
    (Chain((Compare("v", "=", "a"), "OR", Compare("v", "=", "b"), "AND", Compare("n", "=", 1))), ["a", "b"], ["c"]),
]


@pytest.mark.parametrize("index", range(len(CONDITIONS)))
def test_condition(flag_of, index):
    condition, violating, passing = CONDITIONS[index]
    rule = Rule("R", ("v",), violation=condition, thresholds=(("top", 5), ("word", "'yes'")))
    got = flag_of(rule, [*violating, *passing])
    assert flags(got) == [1] * len(violating) + [0] * len(passing)


def test_messages_join_only_conditions_that_hold(flag_of):
    rule = Rule("R", ("v",), violation=any_of(Compare("v", ">", 1), Compare("v", ">", 10), Matches("v", "9$")))
    got = flag_of(rule, ["19", "5", "0"])
    assert [text for _, text in got] == [
        "Condition violated: v > 1, Condition violated: v > 10, Regex pattern violated in v: 9$",
        "Condition violated: v > 1", "",
    ]


def test_unknown_condition_counts_as_not_violated(frame):
    df = frame("a string, b string", ("x", None))
    rule = Rule("R", ("a",), violation=Compare("b", "=", "y", negate=True))
    assert TableCheck(df, [], RUN).flags(rule).first()["rule_violation_flag"] == 0


def test_column_names_with_spaces_and_case(frame):
    df = frame("`Subject Area` string", ("ok",), ("b4d",))
    rows = TableCheck(df, [], RUN).flags(build("DQ_015", "subject area")).collect()
    assert sorted(r["rule_violation_flag"] for r in rows) == [0, 1]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value // 10 + value % 10
    return total % 10 == 0


def test_national_id_checksum_matches_its_definition(flag_of):
    rng = random.Random(3)
    numbers = [f"784{rng.randrange(1900, 2020)}{rng.randrange(10**8):08d}" for _ in range(500)]
    got = flag_of(build("DQ_007", "v", current_year=2026), numbers)
    assert flags(got) == [0 if luhn(n) else 1 for n in numbers]
    assert 0 in flags(got) and 1 in flags(got)


def test_national_id_messages(flag_of):
    lead = "Invalid Emirates ID - "
    got = flag_of(
        build("DQ_007", "v", current_year=2026), ["123-2030-1234567-1", "7841990", "784-19A0-1234567-1", "- -", None]
    )
    assert got[0][1] == (
        f"{lead}Must start with 784, {lead}Year in Emirates ID must be greater than 1800 and less than 2026,"
        f" {lead}Invalid checksum"
    )
    assert got[1][1] == f"{lead}Emirates ID must be 15 digits long, {lead}Invalid checksum"
    assert got[2][1] == f"{lead}Non-numeric characters"
    assert flags(got) == [1, 1, 1, 1, -1]


def test_national_id_against_birth_date(frame):
    df = frame(
        "v string, dob string", ("784198000000002", "1980-05-01"), ("784198000000002", "01-05-1981"),
        ("784198000000002", "01-05-1980 10:00:00"), ("784198000000002", "1.5.1981"),
    )
    rule = build("DQ_007", "v", current_year=2026, dob_column="dob")
    rows = TableCheck(df, [], RUN).flags(rule).collect()
    wrong = [r["dob"] for r in rows if "does not match DOB year" in r["rule_violation_details"]]
    assert wrong == ["01-05-1981"]


def test_national_id_and_condition_either_flags(frame):
    df = frame("v string, w string", ("784198000000002", "a"), ("1", "b"))
    rule = build("DQ_007", "v", current_year=2026, violation=Compare("w", "=", "a"))
    rows = {r["w"]: r["rule_violation_flag"] for r in TableCheck(df, [], RUN).flags(rule).collect()}
    assert rows["b"] == 1 and rows["a"] == 1


def test_plan_needs_no_python_worker(frame):
    df = frame("v string", ("x",))
    rules = [build(r, "v", current_year=2026) for r in ("DQ_001", "DQ_007", "DQ_012", "DQ_015", "DQ_014")]
    plan = TableCheck(df, rules, RUN).summary()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_fixed_lists_are_whole():
    from assaywright.catalog import values as V

    sizes = {"NATIONALITIES": 227, "CURRICULA": 37, "EMIRATES": 8, "GENDERS": 4, "MARITAL_STATUSES": 5}
    for name, size in sizes.items():
        assert len(getattr(V, name)) == len(set(getattr(V, name))) == size
    assert len(set(V.GRADES)) == 68
