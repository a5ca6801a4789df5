"""Display labels in both languages, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- Fixed values ------------------------------------------------------------------------------
MONTHS = {
    "en": ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"],
    "ar": ["يناير", "فبراير", "مارس", "أبريل", "مايو", "يونيو",
           "يوليو", "أغسطس", "سبتمبر", "أكتوبر", "نوفمبر", "ديسمبر"],
}
EFFECTIVE, ROOT_CAUSE = "Effective", "Root-Cause Attention"
DELAY, PRIORITY = "Operational Delay", "Priority Issue"
INSUFFICIENT = "Insufficient data"
GROUPS = [EFFECTIVE, ROOT_CAUSE, DELAY, PRIORITY, INSUFFICIENT]
FLAGGED_GROUPS = [ROOT_CAUSE, PRIORITY]
REVIEW_ORDER = [PRIORITY, ROOT_CAUSE, DELAY, EFFECTIVE]
GROUPS_AR = {
    EFFECTIVE: "فعّال",
    ROOT_CAUSE: "يحتاج تحليل السبب الجذري",
    DELAY: "تأخر تشغيلي",
    PRIORITY: "أولوية قصوى",
}
PERIOD_DASH = " – "
# ------------------------------------------------------------------------------------------------


def month_name(number: Column, lang: str = "en") -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS[lang]]), number.cast("int"))


def month_label(year_month: Column, lang: str = "en") -> Column:
    """``2026-04`` becomes ``Apr 2026``."""
    year, month = F.substring(year_month, 1, 4), F.substring(year_month, 6, 2)
    return F.concat_ws(" ", month_name(month, lang), year)


def period_label(first: Column, last: Column, lang: str = "en") -> Column:
    """Label of a run of quarters: one year is written once, two years are both written."""
    def year(code: Column) -> Column:
        return F.substring(code, 1, 4)

    def quarter(code: Column) -> Column:
        return F.substring(code, -1, 1).cast("int")

    start = month_name(quarter(first) * 3 - 2, lang)
    end = F.concat_ws(" ", month_name(quarter(last) * 3, lang), year(last))
    same_year = year(first) == year(last)
    return F.concat(
        F.when(same_year, start).otherwise(F.concat_ws(" ", start, year(first))),
        F.lit(PERIOD_DASH),
        end,
    )


def group_label(group: Column, lang: str = "en") -> Column:
    if lang == "en":
        return group
    pairs = [F.lit(text) for pair in GROUPS_AR.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[group], group)


def review_rank(group: Column) -> Column:
    """0 for what to look at first; null for groups that are not ranked."""
    pairs = [F.lit(v) for i, name in enumerate(REVIEW_ORDER) for v in (name, i)]
    return F.create_map(*pairs)[group].cast("long")


def pick_language(ar: str, en: str, lang: str) -> str:
    return ar if lang == "ar" else en
