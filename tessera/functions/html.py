"""Extraction from raw HTML columns, by native expressions.

A page is cut into tokens: tags, with whole attributes, and the text between them. A fold over the tokens keeps the stack
of open elements, so an element's text runs from its opening tag to the tag that closes it, through nested elements of
the same name. Elements that are never closed end with the element around them, or with the page.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# One alternation, so that each piece ends where it began: a ``<!--`` inside a
# script is script text, a ``<script>`` inside a comment is a comment.
NOISE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"

#: A name, and a value in quotes of either kind or bare; quotes matter after an equals sign only.
_ATTRIBUTE = r"""(?:=[^\s/>=]*+|[^\s/>=]++)(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
_TAG = rf"</?[a-zA-Z][^\s/>]*+(?:[\s/]++(?:{_ATTRIBUTE})?+)*+>"
_TOKEN = rf"(?s){_TAG}|[^<]++|<"
# Elements without an end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

# Fixed value: what the references to 0x80-0x9F stand for (the code page that pages mean by them).
_C1 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_REFERENCE = r"&(?:#[0-9]++|#[xX][0-9a-fA-F]++|[a-zA-Z][a-zA-Z0-9]*+);?+"


def strip_noise(html: Column) -> Column:
    """Drop comments, scripts and styles (they may contain tag-like text)."""
    return F.regexp_replace(html, NOISE, "")


def _character(code: Column) -> Column:
    """The character of a number; U+FFFD for numbers that are none."""
    ok = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return (F.when(code.between(0x80, 0x9F), F.substr(F.lit(_C1), (code - 0x7F).cast("int"), F.lit(1)))
            .when(ok, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("�"))


def _named() -> Column:
    """name -> characters, with and without the semicolon as the standard has them (the library's own table)."""
    return F.from_json(F.lit(json.dumps(html5, ensure_ascii=True)), "map<string,string>")


def _decoded(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "^&#[xX]?([0-9a-fA-F]+)", 1)
    # longer numbers are no character, whatever their value
    size = F.length(F.ltrim(digits, F.lit("0")))
    code = F.when(size > 7, -1).otherwise(F.conv(digits, 16, 10).cast("bigint"))
    decimal = F.when(size > 7, -1).otherwise(digits.cast("bigint"))
    name = F.substr(reference, F.lit(2))
    # the five that text has to write this way come before the table
    return (F.when(name == "amp;", "&").when(name == "lt;", "<").when(name == "gt;", ">").when(name == "quot;", '"')
            .when(name == "apos;", "'").when(reference.rlike("^&#[xX]"), _character(code)).when(reference.startswith("&#"), _character(decimal))
            .otherwise(F.coalesce(F.try_element_at(_named(), name), reference)))


def unescape(c: Column) -> Column:
    """Character references, by name and by number, once: ``&amp;lt;`` becomes ``&lt;``. Unknown names stay."""
    def joined(references: Column) -> Column:
        return F.array_join(F.transform(F.split(c, _REFERENCE, -1), lambda text, i: F.concat(
            text, F.when(i < F.size(references), _decoded(F.get(references, i))).otherwise(""))), "")

    return F.when(F.instr(c, "&") == 0, c).otherwise(_let(F.regexp_extract_all(c, F.lit(_REFERENCE), 0), joined))


def _tokens(html: Column) -> Column:
    return F.regexp_extract_all(strip_noise(html), F.lit(_TOKEN), 0)


def _is_tag(token: Column) -> Column:
    return token.startswith("<") & (F.length(token) > 1)


def _tag_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>]*)", 1))


def tag_texts(html: Column, tag: str) -> Column:
    """Array of the text of every ``<tag>`` element in the order of their opening tags: inner tags removed, character
    references decoded; of nested elements, the outer text holds the inner one."""
    tag = tag.lower()

    def read(token: Column, at: Column) -> Column:
        name = _tag_name(token)
        kind = (F.when(token.startswith("</"), -1)
                .when(name.isin(*VOID) | token.rlike(r"""(?s)(?:["'\s]|^<[^\s=]*)/>$"""), 2).otherwise(1))
        return F.when(_is_tag(token), F.struct(at.alias("at"), kind.alias("kind"), name.alias("name")))

    def state(names, ids, starts, out, n) -> Column:
        return F.struct(names.alias("names"), ids.alias("ids"), starts.alias("starts"), out.alias("out"), n.alias("n"))

    def element(n, a, b) -> Column:
        return F.struct(n.alias("n"), a.alias("a"), b.alias("b"))

    def closed(s: Column, first: Column, at: Column) -> Column:
        """The elements looked for among the open ones from ``first`` on, which end at token ``at``."""
        found = F.transform(F.sequence(first, F.size(s["ids"])), lambda i: element(
            F.get(s["ids"], i - 1), F.get(s["starts"], i - 1), at))
        return F.filter(found, lambda e: e["n"] >= 0)

    def step(s: Column, t: Column) -> Column:
        wanted = t["name"] == tag
        last = F.size(s["names"]) + 1 - F.array_position(F.reverse(s["names"]), t["name"]).cast("int")
        return (F.when(t["kind"] == 1, state(
                    F.array_append(s["names"], t["name"]), F.array_append(s["ids"], F.when(wanted, s["n"]).otherwise(-1)),
                    F.array_append(s["starts"], t["at"]), s["out"], s["n"] + F.when(wanted, 1).otherwise(0)))
                .when(t["kind"] == 2, state(s["names"], s["ids"], s["starts"], F.array_append(
                    s["out"], element(s["n"], t["at"], t["at"])), s["n"] + 1))
                .when(F.array_contains(s["names"], t["name"]), state(
                    F.slice(s["names"], F.lit(1), last - 1), F.slice(s["ids"], F.lit(1), last - 1),
                    F.slice(s["starts"], F.lit(1), last - 1), F.concat(s["out"], closed(s, last, t["at"])), s["n"]))
                .otherwise(s))

    zero = F.expr("named_struct('names', CAST(array() AS array<string>), 'ids', CAST(array() AS array<int>), "
                  "'starts', CAST(array() AS array<int>), 'out', CAST(array() AS array<struct<n:int,a:int,b:int>>), 'n', 0)")

    def texts(tokens: Column) -> Column:
        def finish(s: Column) -> Column:
            rest = F.when(F.size(s["ids"]) > 0, closed(s, F.lit(1), F.size(tokens)))
            return F.array_sort(F.concat(s["out"], F.coalesce(rest, F.slice(s["out"], 1, 0))))

        # text, and elements that hold nothing and are not looked for, do not change what is open
        tags = F.filter(F.transform(tokens, read), lambda t: t.isNotNull() & ((t["kind"] != 2) | (t["name"] == tag)))
        return F.transform(F.aggregate(tags, zero, step, finish), lambda e: F.array_join(F.transform(
            F.slice(tokens, e["a"] + 1, e["b"] - e["a"]), lambda t: F.when(_is_tag(t), "").otherwise(unescape(t))), ""))

    # only pages with such a tag are folded
    has_tag = F.instr(F.lower(html), f"<{tag}") > 0
    return F.when(has_tag, _let(_tokens(html), texts)).when(html.isNotNull(), F.expr("CAST(array() AS array<string>)"))


def tag_attrs(html: Column, tag: str, attr: str) -> Column:
    """Array of the ``attr`` values (quoted either way, bare, or '' where it has none) of every ``<tag ...>``; tags without
    the attribute are skipped, of a repeated one the last counts."""
    tag, attr = tag.lower(), attr.lower()
    opened = F.filter(_tokens(html), lambda t: t.startswith("<") & ~t.startswith("</") & (_tag_name(t) == tag))

    def own(token: Column) -> Column:
        attributes = F.regexp_extract_all(token, F.lit(rf"[\s/]++({_ATTRIBUTE})"), 1)
        named = F.filter(attributes, lambda a: F.lower(F.regexp_extract(a, r"^(=?[^\s=]*)", 1)) == attr)
        return F.element_at(F.transform(named, lambda a: F.regexp_extract(a, r"(?s)^=?[^\s=]*\s*=\s*(.*)$", 1)), -1)

    quoted = lambda v: v.rlike("""(?s)^(".*"|'.*')$""")
    found = F.transform(F.filter(opened, lambda t: F.size(F.filter(
        F.regexp_extract_all(t, F.lit(rf"[\s/]++({_ATTRIBUTE})"), 1),
        lambda a: F.lower(F.regexp_extract(a, r"^(=?[^\s=]*)", 1)) == attr)) > 0), own)
    return F.transform(found, lambda v: unescape(F.when(quoted(v), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
