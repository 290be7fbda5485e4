import datetime as dt

import pytest

from quarry.functions.period import DayRange, PeriodError, criterion_columns, parse_period

AS_OF = dt.date(2024, 1, 15)
D = dt.date


@pytest.mark.parametrize("text,expected", [
    ("月初未満", DayRange(None, D(2023, 12, 31))),
    ("当日", DayRange(D(2024, 1, 15), D(2024, 1, 15))),
    ("当日のみ", DayRange(D(2024, 1, 15), D(2024, 1, 15))),
    ("前日", DayRange(D(2024, 1, 14), D(2024, 1, 14))),
    ("前日のみ", DayRange(D(2024, 1, 14), D(2024, 1, 14))),
    ("前日まで累積", DayRange(None, D(2024, 1, 14))),
    ("当日まで累積", DayRange(None, D(2024, 1, 15))),
    ("2023年12月1日～前日まで累積", DayRange(D(2023, 12, 1), D(2024, 1, 14))),
    ("2023年12月1日～当日まで累積", DayRange(D(2023, 12, 1), D(2024, 1, 15))),
    ("2023年12月1日〜当日まで累積", DayRange(D(2023, 12, 1), D(2024, 1, 15))),
    ("2023年3月1日～2023年3月5日～までの期間", DayRange(D(2023, 3, 1), D(2023, 3, 5))),
    ("2023年3月1日～2023年3月5日", DayRange(D(2023, 3, 1), D(2023, 3, 5))),
    ("2023年3月1日～3月5日まで", DayRange(D(2023, 3, 1), D(2023, 3, 5))),
    ("2023年3月1日～3月5日の期間", DayRange(D(2023, 3, 1), D(2023, 3, 5))),
    ("3日前時点を1日分", DayRange(D(2024, 1, 12), D(2024, 1, 12))),
    ("2024年1月20日", DayRange(D(2024, 1, 20), D(2024, 1, 20))),
    ("過去7日間", DayRange(D(2024, 1, 8), D(2024, 1, 15))),
    ("過去30日間", DayRange(D(2023, 12, 16), D(2024, 1, 15))),
])
def test_grammar(text, expected):
    assert parse_period(text, AS_OF) == expected


def test_blank_is_no_filter():
    assert parse_period("", AS_OF) is None
    assert parse_period("   ", AS_OF) is None
    assert parse_period(None, AS_OF) is None


@pytest.mark.parametrize("text", ["来週", "2023年13月1日", "2023年1月1日～前日まで", "x日前時点を1日分",
                                  "2023年1月1日～x～までの期間"])
def test_unknown_or_bad_raises(text):
    with pytest.raises(PeriodError):
        parse_period(text, AS_OF)


def test_criteria():
    assert criterion_columns("登録日時") == "created_at"
    assert criterion_columns("更新日時") == "updated_at"
    assert criterion_columns("ログイン日時") == "last_login_at"
    assert tuple(criterion_columns("ログイン日時", is_users_query=True)) == ("updated_at", "last_login_at")
    assert criterion_columns("最終提出日時") == "last_submission_datetime"
    assert criterion_columns("提出期限") == "submission_deadline"
    assert criterion_columns("登録日時", {"登録日時": "o_orderdate"}) == "o_orderdate"
    with pytest.raises(ValueError):
        criterion_columns("削除日")
