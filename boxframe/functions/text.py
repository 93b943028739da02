"""Column functions on identifiers, fixed-point text, timestamps and messages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names whose assignments are masked, and the mask itself.
SECRET_NAMES = ("KAGGLE_KEY", "GH_TOKEN")
MASK = "[REDACTED]"

# Fixed value: the marker of a memory failure.
OUT_OF_MEMORY_MARK = "out of memory"
#: What is advised after one, unless a caller has advice of its own.
OUT_OF_MEMORY_ADVICE = "The device ran out of memory: use a smaller batch or smaller images."

# Fixed value: what counts as white space around a text.
_BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(_BLANKS))


def normalize_id(raw: Column) -> Column:
    """Image ID of a list entry: last path part without its suffix; null when invalid."""
    path = F.regexp_replace(F.translate(strip(raw), "\\", "/"), r"(/\.?)+$", "")
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    return F.when(~stem.isin("", ".", ".."), stem)


def stem_of(path: Column) -> Column:
    """File name of a path without its directory and last suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]+$", "")


def file_name(path: Column) -> Column:
    return F.regexp_extract(F.translate(path, "\\", "/"), r"([^/]*)$", 1)


def extension_of(path: Column) -> Column:
    """Lower-case suffix with its dot, empty when there is none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]*)$", 1))


def fixed6(value: Column) -> Column:
    """Six-decimal text of a double, rounded half-even on its exact binary value.

    ``format_string`` rounds half-up and ``bround`` works on the shortest decimal, so both differ
    from the exact result on values such as 0.0078125; ``format_number`` rounds the binary value.
    """
    return F.translate(F.format_number(value.cast("double"), 6), ",", "")


def label_line(class_id: Column, xc: Column, yc: Column, w: Column, h: Column) -> Column:
    return F.concat_ws(
        " ", class_id.cast("string"), fixed6(xc), fixed6(yc), fixed6(w), fixed6(h)
    )


def _utc(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` in UTC, whatever zone the session has. A time without a zone is taken as it is.

    Patterns are applied in the session's zone, also to times without one, so plain text is cut instead.
    """
    since = F.make_dt_interval(secs=F.unix_seconds(ts.cast("timestamp")).cast("decimal(18,6)"))
    instant = F.expr("timestamp_ntz '1970-01-01 00:00:00'") + since
    plain = F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("string")).otherwise(instant.cast("string"))
    return F.translate(F.substring(plain, 1, 19), " ", "T")


def utc_seconds(ts: Column) -> Column:
    """ISO-8601 text to the second with a Z."""
    return F.concat(_utc(ts), F.lit("Z"))


def utc_compact(ts: Column) -> Column:
    return F.concat(F.translate(_utc(ts), "-:", ""), F.lit("Z"))


def video_run_id(stem: Column, ts: Column, model_sha: Column) -> Column:
    safe = F.regexp_replace(F.regexp_replace(stem, "[^A-Za-z0-9_-]+", "_"), "^_+|_+$", "")
    safe = F.when(safe == "", "video").otherwise(safe)
    return F.concat_ws("_", safe, utc_compact(ts), F.substring(model_sha, 1, 8))


def training_run_id(prefix: Column, ts: Column, commit: Column) -> Column:
    safe = F.regexp_replace(F.regexp_replace(prefix, "[^A-Za-z0-9._-]+", "_"), "^[._-]+|[._-]+$", "")
    short = F.when(F.coalesce(commit, F.lit("")) == "", "nogit").otherwise(F.substring(commit, 1, 7))
    return F.concat_ws("_", safe, utc_compact(ts), short)


def fourcc(code: Column) -> Column:
    """Four-character codec name of an integer code, without NULs at its ends; null when empty."""
    parts = [F.chr(F.shiftright(code, 8 * i).bitwiseAND(255)) for i in range(4)]
    text = F.regexp_replace(F.concat(*parts), "^\\x00+|\\x00+$", "")
    return F.nullif(text, F.lit(""))


def class_name(names: Column, class_id: Column) -> Column:
    """Name from a ``map<int,string>``, or the number itself when the map has none."""
    return F.coalesce(F.try_element_at(names, class_id), class_id.cast("string"))


def numeric_names(names: Column) -> Column:
    """``map<int,string>`` of a ``map<string,string>``; keys that are not digits are dropped."""
    digits = F.map_filter(names, lambda k, _: k.rlike("^[0-9]+$"))
    return F.transform_keys(digits, lambda k, _: k.try_cast("int"))


def redact(
    text: Column, names: Sequence[str] = SECRET_NAMES, values: Sequence[str] = ()
) -> Column:
    """Mask known secret values, longest first, then every ``NAME=value`` assignment."""
    for value in sorted((v for v in values if v), key=len, reverse=True):
        text = F.replace(text, F.lit(value), F.lit(MASK))
    if not names:
        return text
    options = "|".join(re.escape(name) for name in names)
    return F.regexp_replace(text, rf"(?i)\b({options})\s*=\s*([^\s,;]+)", f"$1={MASK}")


def out_of_memory(message: Column) -> Column:
    return F.lower(message).contains(OUT_OF_MEMORY_MARK)


def failure_advice(message: Column, advice: str = OUT_OF_MEMORY_ADVICE) -> Column:
    return F.when(out_of_memory(message), advice)


def is_digest(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-f]{64}$"), F.lit(False))


def digest_matches(actual: Column, expected: Column) -> Column:
    """Equality with an expected SHA-256; null when the expected text is not one."""
    tidy = F.lower(F.trim(expected))
    return F.when(is_digest(tidy), actual == tidy)


def bounded_count(total: Column, fraction: float) -> Column:
    """Half-even share of a total, at least 1 and at most ``total - 1``."""
    share = F.bround(total.cast("double") * F.lit(float(fraction)), 0).cast("bigint")
    return F.least(total - 1, F.greatest(F.lit(1).cast("bigint"), share))
