"""Structure of HTML pages that single tags do not tell: a fold with a stack of open elements.

Lists indent the lists inside them, items of ordered lists are numbered, quotes mark their
lines, the first row of a table that has header cells is underlined, and a link that holds
several blocks is one link in each of them. What is not closed ends with the page; what
closes nothing is passed over.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.functions.scan import scanned

# Stand for what tidying must leave alone: an indent, a quote mark, and a link that was
# opened or closed only because a block began or ended inside it.
INDENT, QUOTE, OPENED, CLOSED, LINK_END = "", "", "", "", ""
PLACEHOLDERS = INDENT + QUOTE + OPENED + CLOSED + LINK_END
NEEDED = r"(?i)<(?:ol|blockquote|th)\b|<(?:ul|ol)\b.*<(?:ul|ol)\b|<li\b[^>]*>\s*<p\b"
LINK_ACROSS = r"(?i)<a\b[^>]*>(?:(?!</a\b).)*?<(?:p|div|h[1-6]|li|ul|ol|tr|table)\b"

LIST_TAGS = ("<ul", "<ol")
LIST_ENDS = ("</ul", "</ol")
PARAGRAPHS = ("<p", "<div", "</p", "</div")
ROW_ENDS = ("<tr", "</tr", "</table", "</thead", "<tbody")
END = "</page"  # stands after the last tag
_HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)')"""

STATE = "struct<lists:array<int>,quotes:int,rows:int,cells:int,head:boolean,link:string>"


def tokens(tags: Column, start: str) -> Column:
    """``name``, name of the tag before, and ``href`` of each tag; one more for the page's end."""
    named = F.transform(
        tags,
        lambda tag: let(
            F.lower(F.regexp_extract(tag, start, 0)),
            lambda name: F.struct(
                name.alias("name"),
                F.when(
                    (name == "<a") & F.rlike(tag, F.lit(_HREF)),
                    F.concat(F.regexp_extract(tag, _HREF, 1), F.regexp_extract(tag, _HREF, 2)),
                ).alias("href"),
            ),
        ),
    )
    end = F.struct(F.lit(END).alias("name"), F.lit(None).cast("string").alias("href"))
    return let(
        F.array_append(named, end),
        lambda all_: F.transform(
            all_,
            lambda token, i: F.struct(
                token["name"].alias("name"),
                F.get(all_, i - 1)["name"].alias("before"),
                token["href"].alias("href"),
            ),
        ),
    )


def step(state: Column, token: Column) -> Column:
    """What is open after a tag."""
    name, lists = token["name"], state["lists"]
    outer = F.slice(lists, 1, F.greatest(F.size(lists) - 1, F.lit(0)))
    top = F.get(lists, F.size(lists) - 1)
    cell = name.isin("<td", "<th")
    closes = name.isin(*ROW_ENDS)
    return F.struct(
        # -1 for a list without numbers, else the last number
        F.when(name == "<ul", F.array_append(lists, F.lit(-1)))
        .when(name == "<ol", F.array_append(lists, F.lit(0)))
        .when(name.isin(*LIST_ENDS), outer)
        .when((name == "<li") & (top >= 0), F.array_append(outer, top + 1))
        .otherwise(lists)
        .alias("lists"),
        F.when(name == "<blockquote", state["quotes"] + 1)
        .when(name == "</blockquote", F.greatest(state["quotes"] - 1, F.lit(0)))
        .otherwise(state["quotes"])
        .alias("quotes"),
        F.when(name == "<table", 0)
        .when(name == "<tr", state["rows"] + 1)
        .otherwise(state["rows"])
        .alias("rows"),
        F.when(closes, 0).when(cell, state["cells"] + 1).otherwise(state["cells"]).alias("cells"),
        F.when(closes, F.lit(False)).otherwise(state["head"] | (name == "<th")).alias("head"),
        F.when(token["href"].isNotNull(), token["href"])
        .when(name.isin("</a", END), F.lit(None).cast("string"))
        .otherwise(state["link"])
        .alias("link"),
    )


def emitted(flat: Column):
    """What stands for a tag; ``flat`` maps names to the texts of tags that need no stack."""

    def emit(before: Column, after: Column, token: Column) -> Column:
        name = token["name"]
        depth = F.size(after["lists"])
        marks = F.repeat(F.lit(QUOTE), after["quotes"])
        inside = F.repeat(F.lit(INDENT), depth)
        top = F.get(after["lists"], depth - 1)
        plain = F.coalesce(flat[name], F.lit(""))
        text = (
            F.when(
                name.isin(*LIST_TAGS),
                F.when(F.size(before["lists"]) == 0, "\n\n").otherwise(""),
            )
            .when(name.isin(*LIST_ENDS), F.when(depth == 0, "\n\n").otherwise(""))
            .when(
                name == "<li",
                F.concat(
                    F.lit("\n"),
                    marks,
                    F.repeat(F.lit(INDENT), depth - 1),
                    F.when(top >= 0, F.concat(top.cast("string"), F.lit(". "))).otherwise("* "),
                ),
            )
            .when(
                name.isin(*PARAGRAPHS) & (depth > 0),
                F.when(
                    F.startswith(name, F.lit("</")) | (token["before"] == "<li"), F.lit("")
                ).otherwise(F.concat(F.lit("\n"), marks, inside)),
            )
            .when(name == "<br", F.concat(F.lit("\n"), marks, inside))
            .when(name.isin("<td", "<th"), F.when(before["cells"] > 0, " | ").otherwise(""))
            .otherwise(F.replace(plain, F.lit("\n\n"), F.concat(F.lit("\n\n"), marks)))
        )
        line_begins = name.isin("<tr", *LIST_TAGS, *LIST_ENDS) & (text != "")
        quoted = F.when(line_begins, F.concat(text, marks)).otherwise(text)
        underline = F.when(
            name.isin(*ROW_ENDS, END) & before["head"] & (before["rows"] <= 1),
            F.concat(
                F.lit("\n"),
                F.repeat(F.lit(QUOTE), before["quotes"]),
                F.array_join(F.array_repeat(F.lit("---"), before["cells"]), "|"),
            ),
        ).otherwise("")
        target = F.concat(F.lit("("), before["link"], F.lit(LINK_END))
        block = F.startswith(text, F.lit("\n")) & (name != "<br")
        whole = F.concat(underline, quoted)
        return (
            F.when(
                token["href"].isNotNull(),
                F.concat(F.coalesce(F.concat(F.lit("]"), target), F.lit("")), F.lit("[")),
            )
            .when(
                name.isin("</a", END),
                F.concat(underline, F.coalesce(F.concat(F.lit("]"), target), F.lit(""))),
            )
            .when(
                block & before["link"].isNotNull(),
                F.concat(F.lit(CLOSED), target, whole, F.lit(OPENED)),
            )
            .otherwise(whole)
        )

    return emit


def tag_texts(tags: Column, start: str, flat: Column) -> Column:
    """A text for each tag, and one for the end of the page."""
    nothing = F.struct(
        F.array().cast("array<int>").alias("lists"),
        F.lit(0).alias("quotes"),
        F.lit(0).alias("rows"),
        F.lit(0).alias("cells"),
        F.lit(False).alias("head"),
        F.lit(None).cast("string").alias("link"),
    ).cast(STATE)
    emit = emitted(flat)
    return let(
        tokens(tags, start), lambda items: scanned(items, nothing, step, emit, "string")
    )


# Links without any text left by blocks, marks and what they stand for.
SETTLE_RULES = (
    (rf"[\[{OPENED}]\s*{CLOSED}\([^{LINK_END}]*{LINK_END}", ""),
    (rf"{OPENED}\s*\]\([^{LINK_END}]*{LINK_END}", ""),
    (rf"([{INDENT}{QUOTE}\[{OPENED}]) +", "$1"),
    (rf" +([{CLOSED}])", "$1"),
    (rf"(?m)^[{INDENT}{QUOTE}]+$", ""),
)
SHOWN = ((INDENT, "  "), (QUOTE, "> "), (OPENED, "["), (CLOSED, "]"), (LINK_END, ")"))


def shown(text: Column) -> Column:
    for placeholder, meaning in SHOWN:
        text = F.replace(text, F.lit(placeholder), F.lit(meaning))
    return text
