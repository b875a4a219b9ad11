"""Chat formatting (DataFrame functions only): a finite-state machine over roles, a declarative
template, text segments with loss flags, and the way back from formatted text to turns.

The machine reads the roles of a conversation in turn order; ``TRANSITIONS`` names the states that
may follow each state.  A conversation is valid if it starts at ``start``, makes allowed moves only
and ends in ``ACCEPT``; the first offending position is reported, and invalid conversations are
formatted as well (callers filter on ``valid``).

The template says, per role, what stands before and after the text and whether the text carries
loss.  Control strings inside a text or role are escaped with a backslash code each, so a formatted
conversation always splits back into exactly its turns (``read_back``).

Defined cases: rows are ordered by turn, then role, then text, nulls first, so ties have one result
and repeated rows stay repeated turns; null text or role counts as empty; rows of a null conv_id are one
conversation; texts of any length are kept whole; an unknown role is kept
under its own name without loss and makes the conversation invalid; other columns are ignored; an
empty table gives an empty result.  A formatted conversation is one record by definition, so a
conversation is gathered into one row, as its digest needs; ``segments`` is the flat form.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: state -> roles that may come next
TRANSITIONS: dict[str, tuple[str, ...]] = {
    "start": ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user",),
}
ACCEPT = ("assistant",)


Codes = tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Template:
    """``open`` + role + ``after_role`` + text + ``close`` per turn; ``loss`` lists the roles trained on.

    ``codes`` (control string -> code, a backslash itself first) are escaped in texts and roles, ``role_codes`` in roles
    as well.  Unless given they are derived: the first characters of ``close``, ``open`` and, in roles, of
    ``after_role`` become codes, so none of these strings can begin inside an escaped text or role."""

    open: str = "### "
    after_role: str = ":\n"
    close: str = "</turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    codes: Codes = ()
    role_codes: Codes = ()

    def __post_init__(self) -> None:
        if not self.close or not self.after_role or any(s.startswith("\\") for s in (self.open, self.after_role, self.close)):
            raise ValueError("a template needs a close and an after_role, and none of its strings may begin with a backslash")
        ends = [s[i:] for s in (self.open, self.after_role) for i in range(len(s))]
        if any(e.startswith(self.close) or self.close.startswith(e) for e in ends):
            raise ValueError("a close may not begin inside an open or after_role")
        if not self.codes:
            controls = dict.fromkeys([self.close[0], *self.open[:1]])
            of_roles = [c for c in [self.after_role[0]] if c not in controls]
            # a code's letter is no control character itself
            letters = (c for c in "echnabdfgijklm" if c not in controls and c not in of_roles)
            coded = [(c, "\\" + letter) for c, letter in zip(["\\", *controls, *of_roles], letters)]
            object.__setattr__(self, "codes", tuple(coded[:1 + len(controls)]))
            object.__setattr__(self, "role_codes", tuple(coded[1 + len(controls):]))


TEMPLATE = Template(codes=(("\\", "\\e"), ("</turn>", "\\c"), ("###", "\\h")), role_codes=(("\n", "\\n"),))


def escape(text: Column, codes) -> Column:
    for control, code in codes:
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescape(text: Column, codes) -> Column:
    # a backslash only ever starts a code, and its own code is undone last
    for control, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(control))
    return text


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, t): a conversation's turns as an ordered array of (turn, role, text)."""
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text")))).alias("t"))


def first_violation(turns: Column, transitions: Mapping[str, tuple[str, ...]] = TRANSITIONS,
                    accept: tuple[str, ...] = ACCEPT) -> Column:
    """0-based position of the first turn the machine refuses, n if it ends early, null if valid."""
    moves = F.array(*[F.concat_ws("\n", F.lit(a), F.lit(b)) for a, bs in transitions.items() for b in bs])
    before = lambda i: F.coalesce(F.get(turns, i - 1)["role"], F.lit("start"))
    refused = F.filter(F.transform(turns, lambda x, i: F.when(
        ~F.array_contains(moves, F.concat_ws("\n", before(i), x["role"])), i)), lambda i: i.isNotNull())
    ends = F.element_at(turns, -1)["role"].isin(*accept)
    return F.coalesce(F.get(refused, F.lit(0)), F.when(~ends, F.size(turns)))


def formatted_turns(turns: Column, template: Template = TEMPLATE) -> Column:
    codes = template.codes
    return F.transform(turns, lambda x: F.concat(
        F.lit(template.open), escape(x["role"], codes + template.role_codes), F.lit(template.after_role),
        escape(x["text"], codes), F.lit(template.close)))


def format_conversations(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, formatted, segments (array of text, role, loss), valid, first_violation.

    The segments in order, joined, are ``formatted``: per turn its opening (no loss), its escaped text
    (loss by the template) and its closing (no loss)."""
    codes = template.codes
    loss = lambda x: x["role"].isin(*template.loss)
    seg = lambda text, role, flag: F.struct(text.alias("text"), role.alias("role"), flag.alias("loss"))
    segments = F.flatten(F.transform("t", lambda x: F.array(
        seg(F.concat(F.lit(template.open), escape(x["role"], codes + template.role_codes), F.lit(template.after_role)),
            x["role"], F.lit(False)),
        seg(escape(x["text"], codes), x["role"], loss(x)),
        seg(F.lit(template.close), x["role"], F.lit(False)))))
    bad = first_violation(F.col("t"))
    return (conversations(turns)
            .select("conv_id", segments.alias("segments"), bad.alias("first_violation"))
            .select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    "segments", F.col("first_violation").isNull().alias("valid"), "first_violation"))


def segments(formatted: DataFrame) -> DataFrame:
    """Flat form: conv_id, segment (0-based), role, loss, text."""
    return (formatted.select("conv_id", F.posexplode("segments").alias("segment", "s"))
            .select("conv_id", "segment", "s.role", "s.loss", "s.text"))


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turns (array of role, text), loss_texts (array), read from formatted text and loss flags only."""
    codes = template.codes
    pieces = F.split(F.col("formatted"), "\\Q" + template.close.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1)  # no pattern
    body = lambda p: F.substring(p, F.lit(len(template.open) + 1), F.length(p))
    head = lambda p: F.substring_index(body(p), template.after_role, 1)
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape(head(p), codes + template.role_codes).alias("role"),
        unescape(F.substring(body(p), F.length(head(p)) + len(template.after_role) + 1, F.length(p)),
                 codes).alias("text")))
    lost = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], codes))
    return formatted.withColumn("turns", turns).withColumn("loss_texts", lost)


#: Conversation -7 of the contract: control strings inside texts.
TRAP_TEXT = "\\### Assistant: </turn> ok"


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    """Digests of all conversations (and the fixed conversation -7), read back from the formatted output."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    trap = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"),
                 F.lit(TRAP_TEXT).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    out = read_back(format_conversations(turns.unionByName(trap)))
    said = F.array_join("loss_texts", "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))),
                            ""), 256).alias("turns_sha256"),
        F.length(said).cast("long").alias("loss_chars"), F.sha2(said, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
), e AS (
  SELECT *, replace(replace(replace(replace(role, '\', '\e'), '</turn>', '\c'), '###', '\h'), chr(10), '\n') AS erole,
         replace(replace(replace(text, '\', '\e'), '</turn>', '\c'), '###', '\h') AS etext,
         coalesce(lag(role) OVER w, 'start') AS before, lead(turn) OVER w IS NULL AS is_last
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(erole) + length(etext) + 14)::BIGINT AS formatted_chars,
       bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'),
                                   ('assistant', 'user')) AND (NOT is_last OR role = 'assistant')) AS valid
FROM e GROUP BY conv_id
"""
