"""Text to token arrays, and array forms of encoded sequences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .chat import ChatTemplate, DEFAULT_TEMPLATE
from .numeric import as_col

# Ids below FIRST_ID are reserved. The pad id is the eos id. A word outside the
# vocabulary is written byte by byte: its first byte above FIRST_BYTE, the others above NEXT_BYTE.
PAD_ID = 0
UNK_ID = 1
START_ID = 2
FIRST_BYTE = 3
NEXT_BYTE = FIRST_BYTE + 256
FIRST_ID = NEXT_BYTE + 256
IGNORE_LABEL = -100

WORDS = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def tokens(text: Column | str, *, template: ChatTemplate | None = None, newlines: bool = False) -> Column:
    """Words (letter/digit runs) and single other signs.

    With ``template`` its markers are one token each; with ``newlines`` line
    breaks are tokens too, so that decoded text keeps its lines.
    """
    options = [WORDS]
    if newlines:
        options.insert(0, r"\n")
    if template:
        options[:0] = [_quote(template.start), _quote(template.end)]
    return F.regexp_extract_all(as_col(text), F.lit(f"({'|'.join(options)})"), F.lit(1))


def _quote(marker: str) -> str:
    return "".join(f"\\{c}" if c in "|.*+?()[]{}^$\\" else c for c in marker)


def reserved_tokens(template: ChatTemplate = DEFAULT_TEMPLATE) -> dict[str, int]:
    return {template.end: PAD_ID, "<unk>": UNK_ID, template.start: START_ID}


def byte_pieces(token: Column | str) -> Column:
    """The ids of a word outside the vocabulary, one per byte of its UTF-8 form."""
    t = as_col(token)
    digits = F.hex(t)
    places = F.sequence(F.lit(0), F.octet_length(t) - 1)
    above = lambda i: F.when(i == 0, FIRST_BYTE).otherwise(NEXT_BYTE)
    byte = lambda i: F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
    # where each character is a byte, its code is read as it is
    plain = F.transform(F.split(t, ""), lambda c, i: F.ascii(c) + above(i))
    return F.when((F.octet_length(t) == F.char_length(t)) & (t != ""), plain).otherwise(F.transform(places, lambda i: byte(i) + above(i)))


def decoded_part(id_: Column | str, token: Column | str) -> Column:
    """What an id adds to a decoded text, in hexadecimal: words and first bytes follow a blank."""
    i = as_col(id_)
    byte = F.lpad(F.hex(F.when(i < NEXT_BYTE, i - FIRST_BYTE).otherwise(i - NEXT_BYTE)), 2, "0")
    word = F.when(as_col(token).isNotNull(), F.concat(F.lit("20"), F.hex(as_col(token))))
    return F.when(i >= FIRST_ID, word).when(i >= NEXT_BYTE, byte).when(i >= FIRST_BYTE, F.concat(F.lit("20"), byte))


def truncate(ids: Column | str, limit: int) -> Column:
    return F.slice(as_col(ids), 1, limit)


def is_truncated(ids: Column | str, limit: int) -> Column:
    return F.size(as_col(ids)) > limit


def attention_mask(length: Column, width: Column | None = None) -> Column:
    """Ones for real tokens, then zeros up to ``width``."""
    ones = F.array_repeat(F.lit(1), length.cast("int"))
    if width is None:
        return ones
    return F.concat(ones, F.array_repeat(F.lit(0), (width - length).cast("int")))


def pad_to(ids: Column | str, width: Column, pad_id: int = PAD_ID) -> Column:
    a = as_col(ids)
    return F.concat(a, F.array_repeat(F.lit(pad_id), (width - F.size(a)).cast("int")))


def causal_labels(
    ids: Column | str,
    *,
    mask_mode: str = "pad_id",
    mask: Column | str | None = None,
    response_start: Column | None = None,
    pad_id: int = PAD_ID,
) -> Column:
    """Labels for next-token training: the ids with some positions set to -100.

    pad_id         every position that holds the pad id, real eos tokens included
    pad_pos        positions that the attention mask marks as padding
    response_only  padding and everything before ``response_start`` (0-based)
    """
    a, ignore = as_col(ids), F.lit(IGNORE_LABEL)
    if mask_mode == "pad_id":
        return F.transform(a, lambda x: F.when(x == pad_id, ignore).otherwise(x))
    if mask is None:
        raise ValueError(f"mask_mode {mask_mode!r} needs the attention mask")
    if mask_mode == "pad_pos":
        return F.zip_with(a, as_col(mask), lambda x, m: F.when(m == 0, ignore).otherwise(x))
    if mask_mode == "response_only":
        if response_start is None:
            raise ValueError("response_only needs response_start")
        shown = F.zip_with(a, as_col(mask), lambda x, m: F.when(m == 0, ignore).otherwise(x))
        return F.transform(shown, lambda x, i: F.when(i < response_start, ignore).otherwise(x))
    raise ValueError(f"unknown mask_mode {mask_mode!r}")
