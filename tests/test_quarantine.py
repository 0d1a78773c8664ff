import pytest
from conftest import HEADER, line

from barkeep.operators.counters import load_counters
from barkeep.plans.load import bars_from_text
from barkeep.plans.quarantine import NO_DAY, load_checked
from barkeep.sources.raw_files import list_files, scan_text


@pytest.fixture
def check(spark, table_name):
    def run(path, **options):
        done = load_checked(spark, path, table_name, f"{table_name}_aside", **options)
        bars = sorted((r.ticker, str(r.trade_date), r.open) for r in spark.table(table_name).collect())
        aside = sorted(
            (str(r.file_day), r.path.rsplit("/", 1)[1], r.row, list(r.reasons))
            for r in spark.table(f"{table_name}_aside").collect()
        )
        return (done.rows_read, done.rows_aside), bars, aside

    return run


def test_rows_end_in_one_of_both_tables(spark, raw_zone, check):
    good = line("a", "2024-01-02")
    lines = [
        good,
        line("b", "2024-01-02", price="x", volume="1.5d"),
        line("", "2024-01-02"),
        "c,1,1,1,1,1,,1",
        "d,1,1,1,1,1,soon,1",
        "short,1,2",
        f"{good},1",
        "e,,,,,,%s," % good.split(",")[6],
    ]
    raw_zone("2024-01-02", lines)
    raw_zone("2024-01-03", [line("A", "2024-01-03"), line("a", "2024-01-03", price="2.0")])
    counts, bars, aside = check(raw_zone.root)
    raw = scan_text(spark, raw_zone.root, with_path=True)
    counted = load_counters(list_files(spark, raw_zone.root), raw, bars_from_text(raw.drop("path"), "permissive")).first()
    assert counts == (10, 6) and counts[0] == counted.rows_staged
    assert [b[:2] for b in bars] == [("A", "2024-01-02"), ("A", "2024-01-03"), ("E", "2024-01-02")]
    assert sorted(reasons for _, _, _, reasons in aside) == sorted(
        [
            ["volume: cannot read 1.5d", "open: cannot read x", "close: cannot read x"],
            ["ticker: missing"],
            ["window_start: missing"],
            ["window_start: cannot read soon"],
            ["wrong number of cells"],
            ["wrong number of cells"],
        ]
    )
    assert {row for _, _, row, reasons in aside if reasons == ["wrong number of cells"]} == {"short,1,2", f"{good},1"}
    assert {file for _, file, _, _ in aside} == {"2024-01-02.csv.gz"}


def test_a_second_load_replaces_what_was_set_aside(raw_zone, check):
    bad, good = line("b", "2024-01-02", price="x"), line("b", "2024-01-02")
    first, second = raw_zone("2024-01-02", [bad]), raw_zone("2024-01-03", [bad])
    assert [a[0] for a in check(raw_zone.root)[2]] == ["2024-01-02", "2024-01-03"]
    assert [a[0] for a in check(first)[2]] == ["2024-01-02", "2024-01-03"]
    raw_zone("2024-01-03", [good])
    counts, bars, aside = check(second)
    assert counts == (1, 0) and bars == [("B", "2024-01-02", 1.0)] and [a[0] for a in aside] == ["2024-01-02"]


def test_files_of_one_day_keep_their_own_rows(raw_zone, check, tmp_path):
    bad = line("b", "2024-01-02", price="x")
    one = raw_zone("2024-01-02", [bad])
    two = raw_zone("2024-01-02", [bad], root="other")
    check(one)
    assert len(check(two)[2]) == 2


def test_other_headers_undated_and_empty_files(raw_zone, check):
    names = HEADER.split(",")
    cells = line("a", "2024-01-02").split(",")
    raw_zone("2024-01-02", [",".join(cells[::-1])], header=",".join(names[::-1]))
    raw_zone("late-file", [line("b", "2024-01-02"), "x"])
    raw_zone("2024-01-04", [])
    counts, bars, aside = check(raw_zone.root)
    assert counts == (3, 1) and [b[0] for b in bars] == ["A", "B"]
    assert [(a[0], a[2]) for a in aside] == [(NO_DAY, "x")]
