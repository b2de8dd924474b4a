"""JSON helpers: tolerant parse, field tokens, claim rules, checksums."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


#: What escaped backslashes and quotes are replaced by while a text is cut; JSON holds neither character as it is.
_BACKSLASH, _QUOTE = "\x01", "\x02"
_STRING = '"[^"]*+"'
_TOKEN = rf'{_STRING}|[{{}}\[\],:]|[^\s"{{}}\[\],:]++'


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _masked(s: Column) -> Column:
    """Text whose strings end at the next quote: no pattern has to step over escapes."""
    return F.replace(F.replace(s, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))


def _unmasked(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _one_value(s: Column) -> Column:
    """Whether the strict parser reads ``s`` as a whole: what follows a value breaks either an array or an object around
    it. It knows no repeated keys."""
    return (F.try_parse_json(F.concat(F.lit("["), s, F.lit("]"))).isNotNull()
            & F.try_parse_json(F.concat(F.lit('{"k":'), s, F.lit("}"))).isNotNull())


def _numbered_keys(masked: Column) -> Column:
    """The text with every key replaced by its number among the strings."""
    pattern = rf"{_STRING}(?:\s*+:)?+"

    def named(strings: Column) -> Column:
        return F.array_join(F.transform(F.split(masked, pattern, -1), lambda text, i: F.concat(text, F.coalesce(
            F.when(F.get(strings, i).endswith(":"), F.concat(F.lit('"'), i.cast("string"), F.lit('":')))
            .otherwise(F.get(strings, i)), F.lit("")))), "")

    return _unmasked(_let(F.regexp_extract_all(masked, F.lit(pattern), 0), named))


def is_json(s: Column) -> Column:
    """Whether a text is one JSON value, repeated keys allowed."""
    # most text that is no JSON shows at its ends, which spares the parser's exception
    clean = (~s.contains(_BACKSLASH) & ~s.contains(_QUOTE) & s.rlike(r'^[ \t\r\n]*+[\[{"0-9tfn-]')
             & s.rlike(r'[\]}"0-9el][ \t\r\n]*$'))
    return F.coalesce(clean & (_one_value(s) | _let(_numbered_keys(_masked(s)), _one_value)), F.lit(False))


def canonical_json(s: Column) -> Column:
    """JSON without the blanks between its tokens, and otherwise as it is written: the order of keys, repeated keys,
    numbers and escapes stay. Text that is not JSON becomes a JSON string."""
    as_text = F.regexp_extract(F.to_json(F.array(s)), r"(?s)^\[(.*)\]$", 1)
    compact = _unmasked(F.regexp_replace(_masked(s), rf"({_STRING})|[ \t\r\n]++", "$1"))
    return F.when(is_json(s), compact).when(s.isNotNull(), as_text)


def field_present(s: Column, field: str) -> Column:
    return F.array_contains(F.json_object_keys(s), field)


def field_text(s: Column, field: str) -> Column:
    """The value of a top-level field as it is written, without blanks; the last of a repeated one, NULL when absent.

    The tokens of the text are folded with their depth, so fields of inner objects do not count."""
    def step(state: Column, token: Column) -> Column:
        text, at, top = token["text"], token["at"], state["depth"] == 1
        opens, closes = text.isin("{", "["), text.isin("}", "]")
        ends = top & (closes | (text == ","))
        mine = ends & (state["key"] == F.lit(field))
        return F.struct(
            (state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"),
            F.when(ends, F.lit(None).cast("string")).when(top & state["key"].isNull() & text.startswith('"'), _string(text))
            .otherwise(state["key"]).alias("key"),
            F.when(top & (text == ":"), at + 1).otherwise(state["start"]).alias("start"),
            F.when(F.coalesce(mine, F.lit(False)), state["start"]).otherwise(state["a"]).alias("a"),
            F.when(F.coalesce(mine, F.lit(False)), at).otherwise(state["b"]).alias("b"))

    zero = F.expr("named_struct('depth', 0, 'key', CAST(NULL AS string), 'start', 0, 'a', CAST(NULL AS int), 'b', CAST(NULL AS int))")

    def found(tokens: Column) -> Column:
        numbered = F.transform(tokens, lambda t, i: F.struct(t.alias("text"), i.alias("at")))
        return F.aggregate(numbered, zero, step, lambda e: F.when(
            F.get(tokens, F.lit(0)) == "{", _unmasked(F.array_join(F.slice(tokens, e["a"] + 1, e["b"] - e["a"]), ""))))

    named = s.contains(json.dumps(field, ensure_ascii=False)) | s.contains("\\")
    return F.when(named & is_json(s), _let(F.regexp_extract_all(_masked(s), F.lit(_TOKEN), 0), found))


def _string(text: Column) -> Column:
    """The value of a JSON string token."""
    plain = ~text.contains("\\") & ~text.contains(_BACKSLASH) & ~text.contains(_QUOTE)
    return F.when(plain, F.substr(text, F.lit(2), F.length(text) - 2)).otherwise(
        F.get_json_object(F.concat(F.lit("["), _unmasked(text), F.lit("]")), "$[0]"))


def field_token(s: Column, field: str) -> Column:
    """Type-aware token of a top-level field so that ``1``, ``1.0``, ``"1"``, ``true`` and ``null`` stay distinct, while
    spellings of one number, one string, or one object in another order of keys are equal; NULL when absent."""
    def token(v: Column) -> Column:
        parsed = F.try_parse_json(v)
        nested = F.coalesce(F.concat(F.schema_of_variant(parsed), F.lit(":"), F.to_json(parsed)), v)
        return (F.when(v.startswith('"'), F.concat(F.lit("string:"), _string(v)))
                .when(v.startswith("{") | v.startswith("["), nested)
                .when(v.rlike("^-?[0-9]+$"), F.concat(F.lit("int:"), F.when(v == "-0", "0").otherwise(v)))
                .when(v.rlike("^-?[0-9]"), F.concat(F.lit("float:"), v.cast("double").cast("string"))).otherwise(v))

    return _let(field_text(s, field), token)


def literal_token(json_text: str) -> Column:
    """Token of a literal value given as JSON text (e.g. ``'42'``)."""
    wrapped = '{"_": ' + json_text + "}"
    return field_token(F.lit(wrapped), "_")


def claim_status(claims: Column, now: Column, audience: str) -> Column:
    """expired when ``exp`` (missing = 0) is before now; invalid when the
    audience differs; else active. ``exp`` equal to now is still valid."""
    exp = F.coalesce(F.get_json_object(claims, "$.exp").cast("double"), F.lit(0.0))
    aud = F.get_json_object(claims, "$.aud")
    return (F.when(exp < now, "expired")
             .when(aud.isNull() | (aud != F.lit(audience)), "invalid")
             .otherwise("active"))


def record_checksum(flag: Column, key: Column, value: Column) -> Column:
    """CRC32 over flag byte, key and payload bytes."""
    return F.crc32(F.concat(F.encode(flag, "UTF-8"), F.encode(key, "UTF-8"),
                            F.encode(F.coalesce(value, F.lit("")), "UTF-8")))
