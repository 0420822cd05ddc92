"""Supervised spans of assistant turns (B9-B11) without a row loop.

Set form of the left-to-right scan: every position where the start marker
matches opens a span that begins right after the marker and ends after the
first complete end marker at or after that point (or runs to the end of
the sequence), capped at ``max_length``. A token is supervised iff some
span contains it. A second start inside a span yields a sub-range of it,
because neither marker contains the other's first id.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import ASSISTANT_END_IDS, ASSISTANT_START_IDS, IGNORE_INDEX
from .util import empty_int_array, let


def _matches_at(ids: Column, i: Column, marker: list[int]) -> Column:
    cond = None
    for j, tok in enumerate(marker):
        c = F.get(ids, i + F.lit(j)) == F.lit(tok)
        cond = c if cond is None else (cond & c)
    return F.coalesce(cond, F.lit(False))


def marker_positions(ids: Column, marker: list[int]) -> Column:
    """0-based positions where the whole marker matches."""
    k = len(marker)
    last = F.size(ids) - F.lit(k)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last),
                                      lambda i: _matches_at(ids, i, marker))
                  ).otherwise(empty_int_array())


def assistant_spans(ids: Column, max_length: int,
                    start: list[int] = ASSISTANT_START_IDS,
                    end: list[int] = ASSISTANT_END_IDS) -> Column:
    """Array of ``struct(lo, hi)``: supervised half-open ranges."""
    kb, ke = len(start), len(end)

    def build(a: Column) -> Column:
        n = F.size(a)

        def with_ends(ends: Column) -> Column:
            def span(s: Column) -> Column:
                body = s + F.lit(kb)
                first_end = F.array_min(F.filter(ends, lambda e: e >= body))
                hi = F.least(F.coalesce(first_end, n) + F.lit(ke), F.lit(int(max_length)))
                return F.struct(body.alias("lo"), hi.alias("hi"))

            return F.transform(marker_positions(a, start), span)

        return let(marker_positions(a, end), with_ends)

    return let(ids, build)


def _in_any(spans: Column, i: Column) -> Column:
    return F.exists(spans, lambda sp: (i >= sp["lo"]) & (i < sp["hi"]))


def span_labels(ids: Column, max_length: int, start: list[int] = ASSISTANT_START_IDS,
                end: list[int] = ASSISTANT_END_IDS) -> Column:
    """Ids inside assistant spans, -100 elsewhere."""
    return let(ids, lambda a: let(assistant_spans(a, max_length, start, end), lambda sp: F.transform(
        a, lambda t, i: F.when(_in_any(sp, i), t).otherwise(F.lit(IGNORE_INDEX)))))


def span_mask(ids: Column, max_length: int, start: list[int] = ASSISTANT_START_IDS,
              end: list[int] = ASSISTANT_END_IDS) -> Column:
    """1 inside assistant spans, 0 elsewhere."""
    return let(ids, lambda a: let(assistant_spans(a, max_length, start, end), lambda sp: F.transform(
        a, lambda t, i: F.when(_in_any(sp, i), F.lit(1)).otherwise(F.lit(0)))))
