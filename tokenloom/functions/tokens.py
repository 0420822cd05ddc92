"""Token projections (text -> ids, truncation, wrapping, padding, labels).

All functions return native Column expressions, so an encoder is one
narrow projection that runs inside the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import (BOS_ID, BYTE_OFFSET, ENDOFTEXT, EOS_ID, IGNORE_INDEX, IM_END, IM_START,
                     MAX_CHARS_PER_TOKEN, PAD_ID, SPECIAL_TOKENS)
from .util import empty_int_array, let

_ALT = "|".join(s[2:-2] for s in SPECIAL_TOKENS)  # endoftext|im_start|im_end
# Zero-width split before and after every special string.
SPECIAL_SPLIT_REGEX = rf"(?=<\|(?:{_ALT})\|>)|(?<=<\|(?:{_ALT})\|>)"


def coerce_text(text: Column) -> Column:
    """B1: ``str(x)``; a missing text becomes the string ``None``."""
    return F.coalesce(text.cast("string"), F.lit("None"))


def utf8_byte_ids(text: Column) -> Column:
    """UTF-8 bytes of a text without special strings, as ids ``byte + 3``.

    The text is re-read as ISO-8859-1 so that every byte is one character;
    ``split(.., '')`` is linear in the length (``substring`` per position is
    quadratic on UTF-8 strings).
    """
    latin1 = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    ids = F.transform(F.split(latin1, ""), lambda c: F.ascii(c) + F.lit(BYTE_OFFSET))
    return F.when(F.length(text) == 0, empty_int_array()).otherwise(ids)


def _special_id(piece: Column) -> Column:
    return (F.when(piece == F.lit(ENDOFTEXT), F.lit(SPECIAL_TOKENS[ENDOFTEXT]))
            .when(piece == F.lit(IM_START), F.lit(SPECIAL_TOKENS[IM_START]))
            .when(piece == F.lit(IM_END), F.lit(SPECIAL_TOKENS[IM_END])))


def token_prefix(text: Column, max_tokens: int) -> Column:
    """Shortest character prefix that still yields the first ``max_tokens`` ids.

    Without a special string starting in the first ``k`` characters every
    one of them is at least one token, so ``k`` characters suffice. Otherwise
    a token covers at most 13 characters (``<|endoftext|>``), and only those
    of special strings cover more than one: ``k`` characters and 12 more for
    each special string that may start in the first ``13 k`` suffice.
    """
    k, most = int(max_tokens), MAX_CHARS_PER_TOKEN

    def marked(t: Column) -> Column:
        return let(F.substring(t, 1, most * k), lambda p: F.substring(p, F.lit(1), F.lit(k) + F.lit(most - 1) * (
            F.length(p) - F.length(F.replace(p, F.lit("<|"), F.lit("<"))))))

    return let(text, lambda t: F.when(F.instr(F.substring(t, 1, k + 1), "<|") == 0,
                                      F.substring(t, 1, k)).otherwise(marked(t)))


def encode_text(text: Column, max_tokens: int | None = None) -> Column:
    """B2/B3 (+B4/B5 when ``max_tokens`` is given): text -> ids.

    Special strings inside the text become their ids, as an added-token
    tokenizer does; everything else is bytes.
    """
    def body(t: Column) -> Column:
        pieces = F.split(t, SPECIAL_SPLIT_REGEX)
        with_specials = F.flatten(F.transform(
            pieces, lambda p: F.when(_special_id(p).isNotNull(), F.array(_special_id(p)))
            .otherwise(utf8_byte_ids(p))))
        return F.when(F.instr(t, "<|") == 0, utf8_byte_ids(t)).otherwise(with_specials)

    if max_tokens is None:
        return let(text, body)
    return F.slice(let(token_prefix(text, max_tokens), body), 1, int(max_tokens))


def truncate(ids: Column, max_tokens: int) -> Column:
    """Keep the first ``max_tokens`` ids."""
    return F.slice(ids, 1, int(max_tokens))


def wrap_bos_eos(ids: Column) -> Column:
    """``[bos] + ids + [eos]``."""
    return F.concat(F.array(F.lit(BOS_ID)), ids, F.array(F.lit(EOS_ID)))


def pad_right(ids: Column, length: int, pad_id: int = PAD_ID) -> Column:
    """Right-pad to ``length`` (never cuts)."""
    return let(ids, lambda a: F.concat(a, F.array_repeat(
        F.lit(pad_id), F.greatest(F.lit(int(length)) - F.size(a), F.lit(0)))))


def pretrain_labels(ids: Column) -> Column:
    """labels = ids with every pad id replaced by -100."""
    return F.transform(ids, lambda t: F.when(t == F.lit(PAD_ID), F.lit(IGNORE_INDEX)).otherwise(t))


def pretrain_pair(tokens: Column, length: int) -> Column:
    """B6-B8 at once: ``struct(input_ids, labels)`` of ``length`` from at most
    ``length - 2`` tokens. Without an id 0 among the tokens (the pad id, which
    labels mask) both are put together from whole arrays."""
    def body(t: Column) -> Column:
        def framed(fill: int) -> Column:
            n = F.lit(int(length) - 2) - F.size(t)
            return F.concat(F.array(F.lit(BOS_ID)), t, F.array(F.lit(EOS_ID)), F.array_repeat(F.lit(fill), n))

        labels = F.when(F.array_contains(t, PAD_ID), pretrain_labels(framed(PAD_ID))).otherwise(framed(IGNORE_INDEX))
        return F.struct(framed(PAD_ID).alias("input_ids"), labels.alias("labels"))

    return let(tokens, body)


def shift_inputs(ids: Column, length: int) -> Column:
    """``ids[:-1]`` of a fixed-length array."""
    return F.slice(ids, 1, int(length) - 1)


def shift_targets(ids: Column, length: int) -> Column:
    """``ids[1:]`` of a fixed-length array."""
    return F.slice(ids, 2, int(length) - 1)


def strip_specials(ids: Column) -> Column:
    """Drop special ids before decoding."""
    specials = F.array(*[F.lit(v) for v in SPECIAL_TOKENS.values()])
    return F.filter(ids, lambda t: ~F.array_contains(specials, t))




def token_count(text: Column) -> Column:
    """Exact token count of a whole text without building the id array: UTF-8
    bytes, less what special strings (they can't overlap) have beyond one."""
    n = F.octet_length(text)
    for special in SPECIAL_TOKENS:
        spare = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(special), F.lit("")))
        n = n - (spare / F.lit(len(special)) * F.lit(len(special) - 1)).cast("int")
    return n.cast("bigint")
