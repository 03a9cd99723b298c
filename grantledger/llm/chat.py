"""Chat formatting with Spark expressions only, and reading the result back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the template's control strings and the letters that stand for them inside texts
MARK = "###"
END = "</turn>"
PART = "</part>"
ESCAPES = ((MARK, "h"), (END, "t"), (PART, "p"), (":", "c"))
#: Roles that the template writes with a capital; all others follow a "=".
ROLES = ("system", "user", "assistant")
LEARNED = "assistant"


def escape(text: Column, also_colon: bool = False) -> Column:
    """`text` without control strings: a backslash is doubled, a control string becomes a backslash and a letter."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, letter in ESCAPES if also_colon else ESCAPES[:-1]:
        text = F.replace(text, F.lit(control), F.lit("\\" + letter))
    return text


def unescape(text: Column) -> Column:
    """The inverse of `escape`. Cut at doubled backslashes, no other backslash stands before one."""

    def piece(part: Column) -> Column:
        for control, letter in ESCAPES:
            part = F.replace(part, F.lit("\\" + letter), F.lit(control))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def _header(role: Column) -> Column:
    known = F.initcap(role)
    return F.concat(
        F.lit(f"{MARK} "),
        F.when(role.isin(*ROLES), known).otherwise(F.concat(F.lit("="), escape(role, also_colon=True))),
        F.lit(": "),
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """One row for each conversation: `conv_id`, `segments`, `formatted`.

    Turns are sorted as structs, adjacent turns of one role merged into one
    block whose parts a control string separates, and blocks concatenated.
    `segments` are (text, learned) pairs whose texts make up `formatted`; the
    learned ones, the loss mask, are the assistant's escaped texts.

    A null text or role counts as empty. Rows with the same turn are ordered by
    role, then text; a null turn comes first; repeated rows are turns of their
    own. A null conversation id is a conversation. An empty table gives an
    empty table. Other columns are not read.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("row"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    role_at = lambda i: F.get("rows", i)["role"]
    heads = F.filter(
        F.sequence(F.lit(0), F.size("rows") - 1), lambda i: (i == 0) | (role_at(i) != role_at(i - 1))
    )
    chats = chats.withColumn("heads", heads)

    def block(head: Column, j: Column) -> Column:
        upto = F.coalesce(F.get("heads", j + 1), F.size("rows"))
        return F.struct(
            role_at(head).alias("role"),
            F.transform(F.slice("rows", head + 1, upto - head), lambda row: row["text"]).alias("texts"),
        )

    chats = chats.withColumn("blocks", F.transform("heads", block))

    def segment(text: Column, learned: Column) -> Column:
        return F.struct(text.alias("text"), learned.alias("learned"))

    def pieces(merged: Column) -> Column:
        learned = merged["role"] == LEARNED
        last = F.size(merged["texts"]) - 1
        parts = F.flatten(
            F.transform(
                merged["texts"],
                lambda text, i: F.array(
                    segment(escape(text), learned),
                    segment(F.when(i < last, F.lit(PART)).otherwise(F.lit(f"{END}\n")), F.lit(False)),
                ),
            )
        )
        return F.concat(F.array(segment(_header(merged["role"]), F.lit(False))), parts)

    chats = chats.withColumn("segments", F.flatten(F.transform("blocks", pieces)))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return chats.select("conv_id", "segments", formatted.alias("formatted"))


def read_back(chats: DataFrame) -> DataFrame:
    """`turns` (role, text) parsed from `formatted`, and `learned`, the unescaped text under the loss mask."""
    blocks = F.split("formatted", f"{END}\n")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def rows(block: Column) -> Column:
        cut = F.split(block, ": ", 2)
        name = F.substring(cut[0], len(MARK) + 2, 1 << 30)
        other = unescape(F.substring(name, 2, 1 << 30))
        role = F.when(name.startswith("="), other).otherwise(F.lower(name))
        return F.transform(
            F.split(cut[1], PART), lambda text: F.struct(role.alias("role"), unescape(text).alias("text"))
        )

    learned = F.transform(F.filter("segments", lambda s: s["learned"]), lambda s: unescape(s["text"]))
    return chats.select(
        "*", F.flatten(F.transform(blocks, rows)).alias("turns"), F.array_join(learned, "").alias("learned")
    )
