"""HTML pages -> text, as a chain of expressions over one column.

Links stay as ``[text](url)``, images and emphasis marks are dropped, nothing is
wrapped and a table row becomes one ``a | b`` line. Pages with nested or numbered lists,
quotes, header cells or links around blocks go through a fold with a stack of what is
open (:mod:`fundglean.functions.structure`); others need none.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundglean.functions import structure
from fundglean.functions.binding import let
from fundglean.functions.text import strip

# Parts of a page that carry no text.
SILENT_PARTS = (
    r"(?is)<!--.*?(?:-->|\z)|<(head|script|style)\b.*?(?:</\1\s*>|\z)"
)

# Links, with either kind of quotes.
LINK_RULES = (
    (r'(?i)<a\b[^>]*?\shref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', "[$2]($1)"),
    (r"(?i)<a\b[^>]*?\shref\s*=\s*'([^']*)'[^>]*>(.*?)</a\s*>", "[$2]($1)"),
)

# What the start of a tag turns into; other tags vanish.
BLOCKS = (
    "p div ul ol dl table article section header footer nav main aside "
    "blockquote pre form body title"
).split()
TAG_TEXT = {
    **{f"<{name}": "\n\n" for name in BLOCKS},
    **{f"</{name}": "\n\n" for name in BLOCKS},
    **{f"<h{n}": "\n\n" + "#" * n + " " for n in range(1, 7)},
    **{f"</h{n}": "\n\n" for n in range(1, 7)},
    "<br": "\n",
    "</br": "\n",
    "<hr": "\n\n* * *\n\n",
    "<li": "\n* ",
    "<tr": "\n",
    "<td": " | ",
    "<th": " | ",
}
# The references most pages consist of; looked at before the full table.
COMMON_ENTITIES = ("amp", "nbsp", "lt", "gt", "quot")
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}

_TAG = r"</?[a-zA-Z!][^>]*(?:>|\z)"
_TAG_START = r"^</?[a-zA-Z][a-zA-Z0-9]*"

# How white space left by the rules above is tidied.
TIDY_RULES = (
    (r" *\n *", "\n"),
    (r"\n{3,}", "\n\n"),
    (r" {2,}", " "),
)

# ``display:none`` in a style attribute, blanks ignored wherever they stand; without
# quotes the value ends at the first blank.
_HIDDEN_VALUE = " *".join("display:none")
_HIDDEN_DIV = (
    r"(?i:<div\b[^>]*?\sstyle\s*=\s*)"
    rf"(?:\"[^\">]*?{_HIDDEN_VALUE}|'[^'>]*?{_HIDDEN_VALUE}|[^\s\"'>]*?display:none)[^>]*>"
)
_DIV_TAG = r"(?i)</?div\b[^>]*>"

# Code points 128-159 of numeric references mean Windows-1252 characters.
_C1 = [(chr(c), bytes([c]).decode("cp1252", "ignore")) for c in range(128, 160)]
_C1_FROM = "".join(a for a, b in _C1 if b)
_C1_TO = "".join(b for _, b in _C1 if b)


def _apply(text: Column, rules) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def remove_silent_parts(html: Column) -> Column:
    """Drop comments, head, scripts and styles."""
    return F.regexp_replace(html, SILENT_PARTS, "")


def remove_hidden_div(html: Column) -> Column:
    """Remove the first ``div`` that is styled ``display:none``, with all it holds.

    Nesting needs a depth count: the tags after the opening one are folded to
    the position of the closing tag that brings the depth back to zero.
    """
    opening = F.regexp_extract(html, _HIDDEN_DIV, 0)

    def without(page: Column, tag: Column) -> Column:
        at = F.instr(page, tag)
        before = F.substring(page, F.lit(1), at - 1)
        after = F.substring(page, at + F.length(tag), F.length(page))
        return F.concat(before, let(after, _after_matching_close))

    return F.when(
        F.rlike(html, F.lit(_HIDDEN_DIV)),
        let(opening, lambda tag: without(html, tag)),
    ).otherwise(html)


def _after_matching_close(rest: Column) -> Column:
    """What follows the ``</div>`` that closes a div opened just before ``rest``."""
    tags = F.regexp_extract_all(rest, F.lit(_DIV_TAG), 0)
    depth_zero = F.aggregate(
        tags,
        F.struct(F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end")),
        lambda state, tag: F.struct(
            (state["depth"] + F.when(F.startswith(tag, F.lit("</")), -1).otherwise(1)).alias(
                "depth"
            ),
            (state["at"] + 1).alias("at"),
            F.when(
                (state["end"] < 0) & (state["depth"] == 1) & F.startswith(tag, F.lit("</")),
                state["at"],
            )
            .otherwise(state["end"])
            .alias("end"),
        ),
        lambda state: state["end"],
    )

    def tail(found: Column, end: Column) -> Column:
        # pieces between tags: piece k + 1 follows tag k
        pieces = F.split(rest, _DIV_TAG)
        kept = F.zip_with(
            F.slice(pieces, end + 2, F.size(pieces)),
            F.slice(found, end + 2, F.size(pieces)),
            lambda piece, tag: F.concat(piece, F.coalesce(tag, F.lit(""))),
        )
        return F.array_join(kept, "")

    return let(
        F.struct(tags.alias("tags"), depth_zero.alias("end")),
        lambda s: F.when(s["end"] >= 0, tail(s["tags"], s["end"])).otherwise(F.lit("")),
    )


def flatten_cells(html: Column) -> Column:
    """Blank out block tags inside table cells, so that a row stays on one line."""
    cell = r"(?i)(?=<t[dh]\b)"
    block = r"(?i)</?(p|div|br|ul|ol|li|h[1-6])\b[^>]*>"

    def flat(part: Column) -> Column:
        end = F.regexp_instr(part, F.lit(r"(?i)</t[dhr]|</table"))
        inside = F.when(end > 0, F.substring(part, F.lit(1), end - 1)).otherwise(part)
        after = F.when(end > 0, F.substring(part, end, F.length(part))).otherwise(F.lit(""))
        return F.concat(F.regexp_replace(inside, block, " "), after)

    parts = F.transform(
        F.split(html, cell), lambda part, i: F.when(i == 0, part).otherwise(flat(part))
    )
    return F.when(F.rlike(html, F.lit(r"(?i)<t[dh]\b")), F.array_join(parts, "")).otherwise(
        html
    )


def replace_tags(html: Column) -> Column:
    """Each tag becomes its text, found by name; the first cell of a row gets no bar.

    The page is cut at its tags once, instead of one pass for every kind of tag.
    """
    texts = F.from_json(F.lit(json.dumps(TAG_TEXT)), "map<string,string>")

    def rendered(names: Column) -> Column:
        return F.transform(
            names,
            lambda name, i: F.when(
                name.isin("<td", "<th") & (F.get(names, i - 1) == "<tr"), F.lit("")
            ).otherwise(F.coalesce(texts[name], F.lit(""))),
        )

    names = F.transform(
        F.regexp_extract_all(html, F.lit(_TAG), 0),
        lambda tag: F.lower(F.regexp_extract(tag, _TAG_START, 0)),
    )
    woven = F.zip_with(
        F.split(html, _TAG),
        let(names, rendered),
        lambda text, tag: F.concat(text, F.coalesce(tag, F.lit(""))),
    )
    return F.array_join(woven, "")


def decode_entities(text: Column) -> Column:
    """Resolve named, decimal and hexadecimal character references."""
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")  # a constant

    def named(ref: Column) -> Column:
        found = F.when(F.startswith(ref, F.lit("#")), numeric(ref))
        for name in COMMON_ENTITIES:
            found = found.when(ref == name, F.lit(ENTITIES[name]))
        return found.otherwise(names[ref])

    reference = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"

    def numeric(ref: Column) -> Column:
        hexadecimal = F.rlike(ref, F.lit("^#[xX]"))
        digits = F.when(hexadecimal, F.substring(ref, 3, 6)).otherwise(
            F.conv(F.substring(ref, 2, 7), 10, 16)
        )
        code = F.lpad(digits, 8, "0")
        char = F.decode(F.unhex(code), "UTF-32")
        valid = (F.upper(code) <= "0010FFFF") & ~F.upper(code).between("0000D800", "0000DFFF")
        return F.when(valid & (code != "00000000"), F.translate(char, _C1_FROM, _C1_TO))

    def resolve(part: Column, ref: Column) -> Column:
        rest = F.substring(part, F.length(ref) + 2, F.length(part))
        return F.coalesce(
            F.when(ref != "", F.concat(named(ref), rest)), F.concat(F.lit("&"), part)
        )

    parts = F.transform(
        F.split(text, "&"),
        lambda part, i: F.when(i == 0, part).otherwise(
            let(F.regexp_extract(part, reference, 1), lambda ref: resolve(part, ref))
        ),
    )
    # The ampersand itself comes last. As patterns, which are looked for in longer steps than
    # F.replace takes; what is left has few ampersands to look behind.
    plain = text
    for name in reversed(COMMON_ENTITIES[1:]):
        plain = F.regexp_replace(plain, f"&{name};", ENTITIES[name])
    settled = let(
        plain,
        lambda most: F.when(
            ~F.rlike(most, F.lit("&(?!amp;)[#A-Za-z]")), F.regexp_replace(most, "&amp;", "&")
        ),
    )
    return F.when(~F.contains(text, F.lit("&")), text).otherwise(
        F.coalesce(settled, F.array_join(parts, ""))
    )


def _flat_text(marked: Column) -> Column:
    plain = let(let(_apply(marked, LINK_RULES), replace_tags), decode_entities)
    return strip(_apply(plain, TIDY_RULES))


def _structured_text(marked: Column) -> Column:
    texts = F.from_json(F.lit(json.dumps(TAG_TEXT)), "map<string,string>")

    def woven(page: Column) -> Column:
        tags = F.regexp_extract_all(page, F.lit(_TAG), 0)
        said = structure.tag_texts(tags, _TAG_START, texts)
        pieces = F.zip_with(F.split(page, _TAG), said, lambda text, tag: F.concat(text, tag))
        return F.array_join(pieces, "")

    own = F.translate(marked, structure.PLACEHOLDERS, "")
    plain = let(let(own, woven), decode_entities)
    (around_lines, blank_lines, blanks) = TIDY_RULES
    rules = (around_lines, *structure.SETTLE_RULES, around_lines, blank_lines, blanks)
    return strip(structure.shown(_apply(plain, rules)))


def html_to_text(html: Column) -> Column:
    """Text of a page; an empty page gives ``''``."""
    page = F.regexp_replace(remove_silent_parts(html), r"[ \t\r\n\f]+", " ")
    marked = let(page, lambda p: let(remove_hidden_div(p), flatten_cells))
    return let(
        marked,
        lambda m: F.when(
            F.rlike(m, F.lit(structure.NEEDED)) | F.rlike(m, F.lit(structure.LINK_ACROSS)),
            _structured_text(m),
        ).otherwise(_flat_text(m)),
    )
