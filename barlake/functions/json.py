"""JSON text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(col: Column, key: str, dtype: str = "string") -> Column:
    """Top-level field ``key`` of a JSON object text, cast with ``try_cast``.

    Non-objects, a missing key and values that do not cast give NULL.
    """
    return F.from_json(col, "map<string,string>").getItem(key).try_cast(dtype)


# One part of a text that holds several documents: strings as a whole, an opening brace only at the part's start or behind
# ``[``, ``,`` or ``:``, a closing one that something of the same document follows, and at last one that nothing of it does.
# Every choice is final (possessive), so a long text is one loop and not a recursion.
PART = (r'\s*+\{?+(?:"(?:[^"\\\n]|\\.)*+"|[^"{}]|(?<=[\[,:]\s{0,99})\{|\}(?=\s*+(?:[,:\]}]|\z))|")*+\}?+')
# Numbers that JSON lacks and that document parsers read all the same.
NOT_FINITE = r"-?\b(?:NaN|Infinity)\b"


def is_one_object(text: Column) -> Column:
    """True if ``text`` is one JSON object and nothing else; never NULL.

    JSON functions stop behind the first value they read. So the text is made
    a member of an object, with a second member behind it whose name depends
    on the text: only if the text is one complete value are these two the
    object's keys. One streaming pass, no parsed copy.
    """
    def alone(t):
        last = F.concat(F.lit("end of "), F.hex(F.xxhash64(t)))
        keys = F.json_object_keys(F.concat(F.lit('{"document":'), t, F.lit(',"'), last, F.lit('":0}')))
        return F.coalesce((F.size(keys) == 2) & (F.element_at(keys, -1) == last), F.lit(False))

    return F.when(F.coalesce(text.rlike(r"^\s*\{"), F.lit(False)), F.when(alone(text), F.lit(True)).when(
        text.rlike(NOT_FINITE), alone(F.regexp_replace(text, NOT_FINITE, "0"))).otherwise(F.lit(False))).otherwise(F.lit(False))


def documents_in(text: Column) -> Column:
    """Every document that ``text`` holds, in order, and every rest: an array of (value, one_object).

    Nearly all texts are one object and are not looked at further. Others are
    cut where an object ends and something that cannot belong to it follows,
    and where one begins that cannot belong to the open one: several documents
    come apart, words before, between and behind them are parts of their own,
    and a document that is cut off takes no other with it. Blank parts are
    left out; a text without any part is one itself.
    """
    part = lambda t, ok: F.struct(t.alias("value"), ok.alias("one_object"))
    parts = F.filter(F.regexp_extract_all(text, F.lit(PART), F.lit(0)), lambda t: t.rlike(r"\S"))
    several = F.transform(parts, lambda t: part(t, is_one_object(t)))
    whole = F.array(part(text, F.lit(False)))
    return F.when(is_one_object(text), F.array(part(text, F.lit(True)))) \
        .when(text.isNull(), whole).otherwise(F.when(F.size(several) > 0, several).otherwise(whole))
