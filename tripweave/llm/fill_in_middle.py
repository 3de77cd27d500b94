"""Fill-in-middle: a text's lines fall into prefix, middle and suffix, which change places.

``regexp_count`` counts a text's units, its id's digest draws two cuts among them, and a pattern
of the row's own, ``(unit{a}+)(unit{b-a}+)(rest)``, captures the three parts in one match, whose
replacement writes them in their new order. The counted groups are possessive: the matcher takes
unit after unit in a loop and never goes back, so a text of a million lines needs no deeper
stack than one of two. All of it is DataFrame code in one narrow pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its break, or the last line without one.
UNIT = r"[^\n]*\n|[^\n]+"


@dataclass(frozen=True)
class Plan:
    """How texts are cut. Of 100 texts about ``rate`` are transformed, and of 100 of these about
    ``spm_rate`` have the suffix first. Markers must not share a character with the inner part
    of one another that could join two of them: each begins with a character that none has
    inside."""

    seed: int = 7
    rate: int = 100
    spm_rate: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        for marker in self.markers:
            if not marker or any(c in "\\$" for c in marker):
                raise ValueError(f"a marker is a text without backslash and dollar: {marker!r}")
            if any(other[0] in marker[1:] for other in self.markers):
                raise ValueError(f"a marker may begin inside {marker!r}")
        if len(set(self.markers)) < 3:
            raise ValueError("markers differ")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _draws(plan: Plan, id_column: str) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of seed and id."""
    named = F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    digest = F.sha2(named, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _between(output: Column, before: str, after: str | None) -> Column:
    """The text between two markers of an output; without ``after`` all that follows."""
    start = F.instr(output, before) + len(before)
    end = F.instr(output, after) if after else F.char_length(output) + 1
    return F.substring(output, start, end - start)


def _parts(plan: Plan, form: Column, output: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix as an output holds them; markers stand nowhere else in it."""
    psm = form == "psm"
    prefix = F.when(psm, _between(output, plan.prefix, plan.suffix)).otherwise(
        _between(output, plan.prefix, plan.middle)
    )
    suffix = F.when(psm, _between(output, plan.suffix, plan.middle)).otherwise(
        _between(output, plan.suffix, plan.prefix)
    )
    return prefix, _between(output, plan.middle, None), suffix


def transform(
    docs: DataFrame, plan: Plan = Plan(), id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row: id, ``n`` units, ``form`` (``plain``, ``psm``, ``spm``), ``output``.

    NULL text counts as empty. A text that is empty or holds a marker stays plain. Rows without
    an id draw from the seed alone; rows that share an id and a text share their result. No
    other column is read, whatever its name; an empty table gives an empty result.
    """
    h1, h2, h3, h4 = _draws(plan, id_column)
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("content"),
        h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"),
    )
    counted = rows.select(
        "*", F.regexp_count("content", F.lit(UNIT)).cast("long").alias("n")
    )
    first, second = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    marked = F.lit(False)
    for marker in plan.markers:
        marked = marked | F.contains("content", F.lit(marker))
    cut = counted.select(
        "id", "content", "n",
        F.least(first, second).alias("a"),
        F.greatest(first, second).alias("b"),
        F.when((F.col("content") == "") | marked | (F.col("h3") % 100 >= plan.rate), "plain")
        .when(F.col("h4") % 100 < plan.spm_rate, "spm")
        .otherwise("psm")
        .alias("form"),
    )
    counted_group = lambda times: F.concat(
        F.lit(f"((?:{UNIT}){{"), times.cast("string"), F.lit("}+)")
    )
    pattern = F.concat(
        F.lit(r"\A"),
        counted_group(F.col("a")),
        counted_group(F.col("b") - F.col("a")),
        F.lit(r"([\s\S]*+)\z"),
    )
    order = F.when(
        F.col("form") == "psm", f"{plan.prefix}$1{plan.suffix}$3{plan.middle}$2"
    ).otherwise(f"{plan.suffix}$3{plan.prefix}$1{plan.middle}$2")
    output = F.when(F.col("form") == "plain", F.col("content")).otherwise(
        F.regexp_replace("content", pattern, order)
    )
    return cut.select(F.col("id").alias(id_column), "n", "form", output.alias("output"))


def restore(
    formed: DataFrame, plan: Plan = Plan(), form: str = "form", output: str = "output"
) -> DataFrame:
    """The rows with ``prefix``, ``middle``, ``suffix`` (NULL where plain) and ``restored``, the
    text before the transformation, rebuilt from form and output alone."""
    plain = F.col(form) == "plain"
    prefix, middle, suffix = (F.when(~plain, x) for x in _parts(plan, F.col(form), F.col(output)))
    own = [F.col(c) for c in formed.columns if c not in ("prefix", "middle", "suffix", "restored")]
    parts = formed.select(
        *own, prefix.alias("prefix"), middle.alias("middle"), suffix.alias("suffix")
    )
    whole = F.when(plain, F.col(output)).otherwise(F.concat("prefix", "middle", "suffix"))
    return parts.withColumn("restored", whole)
