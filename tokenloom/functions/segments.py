"""Run-length form of a chat sample.

Supervision changes only at markers, so a sample's labels are a few runs
``(start, n, supervised)`` over its token positions. One split of the rendered
text at the start marker finds them: what lies behind a start marker is
supervised up to and with the next end marker. Runs are clipped to
``max_length`` and expanded once, by ``slice`` and ``array_repeat``; the cost
goes with the number of runs and the text's length, not with tokens times
spans.

This holds for the byte tokenizer, where the markers' ids and their texts
stand at the same places and token counts of pieces add up. Vocabularies that
merge across a marker's edge need the search in ids (``functions.spans``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import ASSISTANT_END_IDS, ASSISTANT_END_TEXT, ASSISTANT_START_IDS, ASSISTANT_START_TEXT, IGNORE_INDEX
from .tokens import token_count
from .util import let

SEGMENTS = "array<struct<start:int,n:int,supervised:boolean>>"


def _run(n: Column, supervised: bool) -> Column:
    return F.struct(n.cast("int").alias("n"), F.lit(supervised).alias("supervised"))


def _runs(text: Column, max_length: int) -> Column:
    """Runs in order, without starts; the last one covers the padding."""
    s, e = len(ASSISTANT_START_IDS), len(ASSISTANT_END_IDS)
    whole = F.lit(int(max_length))

    def of_piece(p: Column, i: Column, count: Column) -> Column:
        marker = F.when(i < count - 1, F.lit(s)).otherwise(F.lit(0))  # the start marker behind the piece
        at = F.instr(p, ASSISTANT_END_TEXT)
        body = F.substring(p, F.lit(1), at - 1)
        rest = F.substring(p, at + len(ASSISTANT_END_TEXT), F.length(p))
        return (F.when(i == 0, F.array(_run(token_count(p) + marker, False)))
                .when(at > 0, F.array(_run(token_count(body) + e, True), _run(token_count(rest) + marker, False)))
                # no end marker: a start marker within the span, or a span that stays open
                .when(i < count - 1, F.array(_run(token_count(p) + marker, True)))
                .otherwise(F.array(_run(whole, True))))

    def runs(pieces: Column) -> Column:
        return F.flatten(F.transform(pieces, lambda p, i: of_piece(p, i, F.size(pieces))))

    found = let(F.split(text, re.escape(ASSISTANT_START_TEXT)), runs)
    return F.concat(found, F.array(_run(whole, False)))


def marker_segments(text: Column, max_length: int) -> Column:
    """``array<struct(start, n, supervised)>`` over exactly ``max_length``
    positions of the padded sample of ``text``."""
    L = F.lit(int(max_length))

    def add(acc: Column, r: Column) -> Column:
        n = F.least(r["n"], L - acc["at"])
        run = F.struct(acc["at"].alias("start"), n.alias("n"), r["supervised"].alias("supervised"))
        return F.struct((acc["at"] + n).alias("at"),
                        F.when(n > 0, F.concat(acc["out"], F.array(run))).otherwise(acc["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(SEGMENTS).alias("out"))
    return F.aggregate(_runs(text, max_length), first, add, lambda acc: acc["out"])


def segment_labels(segments: Column, ids: Column) -> Column:
    """The padded ids in supervised runs, -100 elsewhere."""
    return F.flatten(F.transform(segments, lambda r: F.when(
        r["supervised"], F.slice(ids, r["start"] + 1, r["n"])).otherwise(
        F.array_repeat(F.lit(IGNORE_INDEX), r["n"]))))


def segment_mask(segments: Column) -> Column:
    """1 in supervised runs, 0 elsewhere."""
    return F.flatten(F.transform(segments, lambda r: F.array_repeat(r["supervised"].cast("int"), r["n"])))


def n_supervised(segments: Column) -> Column:
    """Supervised positions, from the runs alone."""
    return F.aggregate(segments, F.lit(0), lambda acc, r: acc + F.when(r["supervised"], r["n"]).otherwise(0))
