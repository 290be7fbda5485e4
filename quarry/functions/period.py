"""Calendar-period filters.

A manifest names a period in words (``前日``, ``2024年1月1日～前日まで累積``,
``3日前時点を1日分`` ...). The words are read once on the driver into an
inclusive range of days; the range then becomes a predicate on one column,
or on either of two columns (P13). Every form is a test on ``DATE(c)``; it is
emitted as ``c >= d1 AND c < d2 + 1 day`` so that the Parquet scan can skip
row groups.

``as_of`` stands for the reference's "today" (the server's date) and is a
parameter so that results are reproducible.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame

from quarry.functions.filters import day_range

# The period phrases of the job manifest.
BEFORE_MONTH = "月初未満"
TODAY = "当日"
YESTERDAY = "前日"
UP_TO_YESTERDAY = "前日まで累積"
UP_TO_TODAY = "当日まで累積"
TODAY_ONLY = "当日のみ"
YESTERDAY_ONLY = "前日のみ"
LAST_7_DAYS = "過去7日間"
LAST_30_DAYS = "過去30日間"
RANGE_MARK = "～"            # U+FF5E, the manifest's range mark
RANGE_MARK_ALT = "〜"        # U+301C, accepted as the same mark
CUMULATIVE = "まで累積"
UNTIL = "まで"
OF_PERIOD = "の期間"
UNTIL_PERIOD = "までの期間"
DAYS_AGO_ONE_DAY = "日前時点を1日分"
DATE_WORDS = ("年", "月", "日")
DATE_LAYOUT = "%Y年%m月%d日"

# Period criteria and the columns they name.
CRITERIA_COLUMNS = {
    "登録日時": "created_at",
    "更新日時": "updated_at",
    "ログイン日時": "last_login_at",
    "最終提出日時": "last_submission_datetime",
    "提出期限": "submission_deadline",
}
LOGIN_CRITERION = "ログイン日時"
LOGIN_COLUMNS = ("updated_at", "last_login_at")
MASTER_CATEGORY = "マスタ"


class PeriodError(ValueError):
    """The period text is not part of the grammar or holds a bad date."""


@dataclass(frozen=True)
class DayRange:
    """Inclusive calendar days; ``None`` on a side means unbounded."""

    start: dt.date | None
    end: dt.date | None

# The range grammar: a start, the mark, then a word, an end with the period
# suffix behind a second mark, or an end that may leave its year out.
RANGE = re.compile(
    f"(?P<start>[^{RANGE_MARK}]+){RANGE_MARK}"
    f"(?:\\s*(?P<word>{UP_TO_YESTERDAY}|{UP_TO_TODAY})\\s*"
    f"|(?P<until>[^{RANGE_MARK}]+){RANGE_MARK}\\s*{UNTIL_PERIOD}\\s*"
    f"|(?P<end>[^{RANGE_MARK}]+))")


def _date(text: str) -> dt.date:
    try:
        return dt.datetime.strptime(text.strip(), DATE_LAYOUT).date()
    except ValueError as exc:
        raise PeriodError(f"bad date in period: {text!r}") from exc


def parse_period(text: str | None, as_of: dt.date) -> DayRange | None:
    """Read a period phrase. ``None`` for a blank phrase (no filter);
    ``PeriodError`` for anything outside the grammar."""
    if text is None or not text.strip():
        return None
    phrase = text.strip().replace(RANGE_MARK_ALT, RANGE_MARK)
    today = as_of
    yesterday = today - dt.timedelta(days=1)

    fixed = {
        BEFORE_MONTH: DayRange(None, today.replace(day=1) - dt.timedelta(days=1)),
        TODAY: DayRange(today, today),
        TODAY_ONLY: DayRange(today, today),
        YESTERDAY: DayRange(yesterday, yesterday),
        YESTERDAY_ONLY: DayRange(yesterday, yesterday),
        UP_TO_YESTERDAY: DayRange(None, yesterday),
        UP_TO_TODAY: DayRange(None, today),
        LAST_7_DAYS: DayRange(today - dt.timedelta(days=7), today),
        LAST_30_DAYS: DayRange(today - dt.timedelta(days=30), today),
    }
    if phrase in fixed:
        return fixed[phrase]

    if RANGE_MARK in phrase:
        span = RANGE.fullmatch(phrase)
        if span is None or (span["end"] and CUMULATIVE in phrase):
            raise PeriodError(f"unknown period: {text!r}")
        start = _date(span["start"])
        if span["word"]:
            return DayRange(start, yesterday if span["word"] == UP_TO_YESTERDAY else today)
        if span["until"]:
            return DayRange(start, _date(span["until"]))
        end_text = span["end"].replace(UNTIL, "").replace(OF_PERIOD, "").strip()
        has_year = DATE_WORDS[0] in end_text
        return DayRange(start, _date(end_text if has_year else f"{start.year}{DATE_WORDS[0]}{end_text}"))

    if phrase.endswith(DAYS_AGO_ONE_DAY):
        count = phrase[: -len(DAYS_AGO_ONE_DAY)]
        if not re.fullmatch(r"\d+", count):
            raise PeriodError(f"bad day count in period: {text!r}")
        day = today - dt.timedelta(days=int(count))
        return DayRange(day, day)

    if all(word in phrase for word in DATE_WORDS):
        day = _date(phrase)
        return DayRange(day, day)

    raise PeriodError(f"unknown period: {text!r}")


def period_predicate(df: DataFrame, text: str | None, columns: str | Sequence[str],
                     as_of: dt.date, on_unknown: str = "raise") -> Column | None:
    """The period as a predicate on ``columns`` (OR over several, P13).

    ``on_unknown='ignore'`` keeps the reference's behaviour for unknown or
    unparsable phrases: no filter, full data.
    """
    try:
        days = parse_period(text, as_of)
    except PeriodError:
        if on_unknown == "ignore":
            return None
        raise
    if days is None:
        return None
    names = [columns] if isinstance(columns, str) else list(columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n in names if n not in types]
    if missing:
        raise KeyError(f"period column not in frame: {missing}")
    preds = [day_range(n, types[n], days.start, days.end) for n in names]
    return reduce(lambda a, b: a | b, preds)


def period_filter(df: DataFrame, text: str | None, columns: str | Sequence[str],
                  as_of: dt.date, category: str | None = None,
                  on_unknown: str = "raise") -> DataFrame:
    """P1-P16 on a frame. A master-category dataset is never period-filtered
    (P15)."""
    if category == MASTER_CATEGORY:
        return df
    pred = period_predicate(df, text, columns, as_of, on_unknown)
    return df if pred is None else df.filter(pred)


def criterion_columns(criterion: str, mapping: dict[str, str | Sequence[str]] | None = None,
                      is_users_query: bool = False) -> str | Sequence[str]:
    """Criterion word -> column(s). A dataset's own mapping wins over
    the default names. The login criterion on a users query tests either
    ``updated_at`` or ``last_login_at`` (P13)."""
    if mapping and criterion in mapping:
        return mapping[criterion]
    if criterion == LOGIN_CRITERION and is_users_query:
        return LOGIN_COLUMNS
    if criterion in CRITERIA_COLUMNS:
        return CRITERIA_COLUMNS[criterion]
    raise ValueError(f"unknown period criterion: {criterion!r}")
