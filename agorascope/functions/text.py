"""Text and key functions as column expressions, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from agorascope.vocabulary import AI_WORDS, CRITIQUE_FLAIRS, ENGLISH_STOPWORDS, REMOVED_MARKERS

#: White space as the source system sees it, odd spaces included.
SPACE = "[\\t\\n\\x0B\\f\\r \\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]"
NOT_SPACE = SPACE.replace("[", "[^", 1)
QUOTE_MIN_CHARS, REMOVED_MIN_CHARS = 25, 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(value: Column) -> Column:
    """``value``, which filters on it see as it is: the condition always holds, but no filter is moved below it, where the
    whole expression would be computed for the filter and then again for the column."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


#: What the normal form leaves out, in this order, and what stands in its place. Equal hashes depend on them.
NORMAL_FORM = (
    ("```[\\s\\S]*?```", " "),
    ("https?://" + NOT_SPACE + "+", " "),
    ("&[a-z]{2,8};", " "),
    ("[*_~`>#|]+", " "),
    ("\\[([^\\]]*)\\]\\([^)]*\\)", "$1"),
    ("[0-9]{1,4}([-/][0-9]{1,4}){1,2}", " "),
)
#: What a text must hold for a step of the normal form to change it; a search for it costs a fraction of the step.
HINTS = ("```", "http", "&", None, "](", None)


def normalize(text: Column) -> Column:
    """Lower case without fenced code, links, entities, markup and date stamps, white space collapsed; order matters."""
    def step(value: Column, pattern: str, put: str, hint: str | None) -> Column:
        if pattern.startswith("[*"):  # single characters, each to a space, as spaces are collapsed in the end
            return F.translate(value, pattern[1:-2], " " * len(pattern[1:-2]))
        change = lambda v: F.regexp_replace(v, pattern, put)
        return _let(value, lambda v: F.when(F.contains(v, F.lit(hint)), change(v)).otherwise(v)) if hint else change(value)

    out = F.lower(F.coalesce(text, F.lit("")))
    for (pattern, put), hint in zip(NORMAL_FORM, HINTS, strict=True):
        out = step(out, pattern, put, hint)
    return collapse(out)


def hash_text(normalized: Column) -> Column:
    return F.substring(F.sha1(F.encode(normalized, "UTF-8")), 1, 16)


def hash_if_eligible(text: Column, min_chars: int) -> Column:
    """Hash of the normalised text, null if that is shorter than ``min_chars``."""
    return _let(normalize(text), lambda n: F.when(F.length(n) >= min_chars, hash_text(n)))


def utf16_length(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("long")


def week_key(epoch: Column) -> Column:
    """Year and week counted from the Sunday on or before January 1, partial days rounded up."""
    ts = F.timestamp_seconds(epoch)
    first = F.date_trunc("year", ts)
    week = F.ceil(((epoch - F.unix_timestamp(first)) / 86400 + F.dayofweek(first)) / 7)
    return F.concat(F.year(ts).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def sub_mentions(text: Column, own: Column, most: int = 30) -> Column:
    """Communities named as ``r/Name``, lower case, each once, without one's own."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?<![A-Za-z0-9_])r/([A-Za-z0-9_]{3,21})(?![A-Za-z0-9_])"), F.lit(1))
    return F.slice(F.array_remove(F.array_distinct(F.transform(found, F.lower)), F.lower(own)), 1, most)


def mentions_ai(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(f"(?i)(?<![A-Za-z0-9_])({AI_WORDS})(?![A-Za-z0-9_])")


def looks_non_english(text: Column) -> Column:
    """Fewer than two of twenty English words in the first 200 normalised characters; never for short texts."""
    def few(window):
        return sum((F.when(F.instr(window, f" {w} ") > 0, 1).otherwise(0) for w in ENGLISH_STOPWORDS), F.lit(0)) < 2

    padded = lambda n: F.concat(F.lit(" "), F.substring(n, 1, 200), F.lit(" "))
    return _let(normalize(text), lambda n: (F.length(n) >= 40) & _let(padded(n), few))


def is_empty_or_removed(text: Column) -> Column:
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")
    return _let(trimmed, lambda t: (F.length(t) < REMOVED_MIN_CHARS) | F.lower(t).isin(*REMOVED_MARKERS))


def critique_flaired(flair: Column) -> Column:
    return F.coalesce(F.lower(flair).rlike("|".join(CRITIQUE_FLAIRS)), F.lit(False))


def row_key(kind: Column, id: Column) -> Column:
    return F.when(kind == "comment", F.concat(F.lit("c_"), id)).otherwise(id)


def id_of_row_key(key: Column) -> Column:
    return F.regexp_replace(key, "^c_", "")


def l2_normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(vector, lambda x: x / F.when(norm == 0, 1.0).otherwise(norm))


def dot(a: Column, b: Column) -> Column:
    """Dot product over the shorter length, in index order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0)).cast("double")), F.lit(0.0), lambda s, x: s + x)


def vector_to_base64(vector: Column) -> Column:
    """Base64 of the vector's elements as little-endian 32-bit floats, in Arrow batches: Spark has no function for a float's bits."""
    import base64

    import numpy as np

    @F.pandas_udf("string")
    def encoded(vectors):
        return vectors.map(lambda v: None if v is None else base64.b64encode(np.asarray(v, "<f4").tobytes()).decode())

    return encoded(vector)


def vector_from_base64(text: Column) -> Column:
    """array<float> from the base64 of little-endian 32-bit floats; null for null or torn values.

    A float is put together from its bits: sign, exponent and fraction. Infinities and NaN read as null elements.
    """
    def element(hex8: Column) -> Column:
        order = F.concat(*[F.substring(hex8, k, 2) for k in (7, 5, 3, 1)])
        bits = F.conv(order, 16, 10).cast("long")
        sign = F.when(F.shiftright(bits, 31) == 1, -1.0).otherwise(1.0)
        exponent, fraction = F.shiftright(bits, 23).bitwiseAND(F.lit(255)), bits.bitwiseAND(F.lit(0x7FFFFF))
        normal = sign * (1 + fraction / 2.0**23) * F.pow(F.lit(2.0), exponent - 127)
        return F.when(exponent == 255, None).when(exponent == 0, sign * fraction * 2.0**-149).otherwise(normal).cast("float")

    def of(digits: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), (F.length(digits) / 8 - 1).cast("int")), lambda i: F.substring(digits, i * 8 + 1, F.lit(8)))
        return F.when(
            (F.length(digits) > 0) & (F.length(digits) % 8 == 0), F.transform(each, element),
        ).when(F.length(digits) == 0, F.array().cast("array<float>"))

    return _let(F.hex(F.try_to_binary(text, F.lit("base64"))), of)


def chunks(text: Column, size: int = 30_000) -> Column:
    """Pieces of ``size`` characters; joined they are the text."""
    return F.when(
        F.length(text) == 0, F.array(F.lit("")),
    ).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / size).cast("int")), lambda i: F.substring(text, i * size + 1, F.lit(size))))


def shrink_fields(fields: Column, budget: int) -> Column:
    """(kept, dropped) of a map of texts: the longest fields go until the others have at most ``budget`` characters.

    Running totals are made in one pass over the fields in order of length.
    """
    sizes = F.array_sort(F.transform(
        F.map_entries(fields), lambda e: F.struct(F.coalesce(F.length(e["value"]), F.lit(0)).cast("long").alias("n"), e["key"].alias("key")),
    ))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<string>").alias("keys"))

    def take(state: Column, x: Column) -> Column:
        total = state["total"] + x["n"]
        return F.struct(total.alias("total"), F.when(total <= budget, F.array_append(state["keys"], x["key"])).otherwise(state["keys"]).alias("keys"))

    keys = F.aggregate(sizes, start, take, lambda state: state["keys"])
    return _let(
        keys,
        lambda k: F.struct(
            F.map_filter(fields, lambda key, _: F.array_contains(k, key)).alias("kept"),
            F.array_sort(F.array_except(F.map_keys(fields), k)).alias("dropped"),
        ),
    )


def marked(kept: Column, dropped: Column) -> Column:
    """The kept fields, with ``_truncated`` naming the dropped ones, if any."""
    return F.when(F.size(dropped) > 0, F.map_concat(kept, F.create_map(F.lit("_truncated"), F.array_join(dropped, ",")))).otherwise(kept)


def shrink_list(values: Column, budget: int) -> Column:
    """The list, halved from its end until its JSON has at most ``budget`` characters."""
    def of(v: Column) -> Column:
        ends = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.call_function("shiftright", F.size(v), k.cast("int")))
        return F.slice(
            v, F.lit(1), F.coalesce(F.get(F.filter(ends, lambda n: F.length(F.to_json(F.slice(v, F.lit(1), n))) <= budget), F.lit(0)), F.lit(0)),
        )

    return F.when(F.length(F.to_json(values)) <= budget, values).otherwise(_let(values, of))
