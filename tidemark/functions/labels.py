"""Labels derived from ranges and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import spec


def _first_match(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases), otherwise)


def _by_product_range(product_id: Column, value) -> Column:
    cases, start = [], spec.PRODUCT_ID_FIRST
    for last, category, label in spec.PRODUCT_RANGES[:-1]:
        cases.append((product_id.between(start, last), value(category, label)))
        start = last + 1
    _, category, label = spec.PRODUCT_RANGES[-1]
    return _first_match(cases, value(category, label))


def product_category(product_id: Column) -> Column:
    return _by_product_range(product_id, lambda category, _: F.lit(category))


def product_label(product_id: Column) -> Column:
    return _by_product_range(
        product_id, lambda _, label: F.concat(F.lit(label + " "), product_id.cast("string"))
    )


def rfm_code(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    return F.concat(*[F.col(c).cast("string") for c in (r, f, m)])


def rfm_segment() -> Column:
    """Segment name from the columns ``r_score``, ``f_score`` and ``m_score``."""
    cases = [(F.expr(condition), F.lit(name)) for name, condition in spec.RFM_SEGMENTS.items()]
    return _first_match(cases, F.lit(spec.RFM_SEGMENT_OTHERWISE))


def churn_band(recency_days: Column) -> Column:
    cases = [(recency_days > days, F.lit(band)) for band, days in spec.CHURN_BANDS.items()]
    return _first_match(cases, F.lit(spec.CHURN_OTHERWISE))
