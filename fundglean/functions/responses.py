"""Prompts for, and JSON responses from, an extraction model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.functions.text import strip
from fundglean.schemas import RESPONSE

SNIPPET_MARK = "{SEC_FILING_SNIPPET}"

PROMPT = f"""Below is part of a fund's registration filing.

<snippet>
{SNIPPET_MARK}
</snippet>

Say whether it states what trustees, directors or board members are paid. If it
does, list every trustee with name, job title and the amounts paid by the fund,
by the fund group, as deferred and as any other compensation; read footnotes to
the table too. Write amounts without dollar sign and commas, and N/A where there
is none. If nothing is stated, set the flag to false, leave the list empty and
say so in the notes. Answer with JSON of this form only:

{{"compensation_info_present": true,
 "trustees": [{{"year": "", "name": "", "job_title": "", "fund_compensation": "",
   "fund_group_compensation": "", "deferred_compensation": "",
   "other_compensation": {{"type": "amount"}}}}],
 "notes": ""}}
"""

# Fixed value: what is returned when model calls are skipped.
DUMMY_RESPONSE = """```json
{
    "notes":"extraction skippped",
    "trustees":[],
    "compensation_info_present":false
 }
```
"""

MIN_WRAPPED = 20  # responses of this length or less are left alone


def fill_prompt(snippet: Column, template: str = PROMPT) -> Column:
    return F.replace(F.lit(template), F.lit(SNIPPET_MARK), snippet)


def _is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def unwrap_json(response: Column) -> Column:
    """Take JSON out of a markdown fence, if what is inside parses."""
    opening, fence = "```json", "```"

    def inside(whole: Column, at: Column) -> Column:
        last = F.length(whole) - F.instr(F.reverse(whole), fence) - len(fence) + 2
        start = at + len(opening)
        fenced = F.substring(whole, start, F.greatest(last - start, F.lit(0)))
        return F.when(at > 0, fenced).otherwise(strip(whole))

    def unwrapped(whole: Column) -> Column:
        candidate = let(F.instr(whole, opening), lambda at: inside(whole, at))
        taken = let(candidate, lambda text: F.when(_is_json(text), text).otherwise(whole))
        return F.when(F.length(whole) > MIN_WRAPPED, taken).otherwise(whole)

    return let(response, unwrapped)


def trustee_count(response: Column) -> Column:
    """Length of the ``trustees`` array; NULL if it is missing or no array."""
    listed = F.try_variant_get(F.try_parse_json(response), "$.trustees", "array<variant>")
    return let(listed, lambda people: F.when(people.isNotNull(), F.size(people)))


def response_view(response: Column) -> Column:
    """Typed struct of a response."""
    return F.from_json(response, RESPONSE)
