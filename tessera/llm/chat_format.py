"""Chat formatting: a finite-state machine over roles and a declarative template with loss flags per segment.

Native: DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written: open, role, header_end, text, close. Every control string starts with `guard`."""

    open: str = "<|im_start|>"
    header_end: str = "<|im_sep|>"
    close: str = "<|im_end|>"
    guard: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; a conversation is valid if it ends in one of `final`.
    turns: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user", "tool": "tool"},
            "tool": {"assistant": "assistant"},
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if len(self.guard) < 2 or not all(s.startswith(self.guard) for s in (self.open, self.header_end, self.close)):
            raise ValueError("control strings must start with a guard of two characters or more")


def escape(c: Column, t: Template) -> Column:
    """Put a backslash before each backslash and inside each guard, so that no control string is left in a text."""
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(t.guard), F.lit(t.guard[0] + "\\" + t.guard[1:]))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def final_state(roles: Column, t: Template) -> Column:
    """The machine's state after all roles; 'invalid' from the first turn out of order on."""
    arcs = [(f"{s}>{r}", n) for s, by in t.turns.items() for r, n in by.items()]
    table = F.create_map(*[F.lit(x) for arc in arcs for x in arc])
    return F.aggregate(roles, F.lit("start"), lambda s, r: F.coalesce(F.try_element_at(table, F.concat(s, F.lit(">"), r)), F.lit("invalid")))


def format_chats(turns: DataFrame, template: Template | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, segments, state, valid.

    segments lists (text, loss) in order; their texts joined are `formatted`. A conversation whose turns are out of
    order is formatted all the same, with valid false. Null role or text: empty. Null ids form one conversation; a null
    turn comes first; equal turns go by role, then text; repeated rows stay. An empty table gives no rows. Its rows must be together to be one text, so a conversation is as large as its group; the
    rows of all other conversations stay apart. Texts stay whole however long. Other columns are ignored, also those
    named as the output's.
    """
    t = template or Template()
    rows = turns.select(F.col(id_col).alias("conv_id"), F.struct(F.col(turn_col).alias("n"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("turn"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    parts = lambda x: F.array(
        segment(F.concat(F.lit(t.open), escape(x["role"], t), F.lit(t.header_end)), F.lit(False)),
        segment(escape(x["text"], t), x["role"].isin(*t.loss_roles)),
        segment(F.lit(t.close), F.lit(False)),
    )
    state = final_state(F.transform("turns", lambda x: x["role"]), t)
    out = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.flatten(F.transform("turns", parts)).alias("segments"), state.alias("state"))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return out.select("conv_id", "n_turns", formatted.alias("formatted"), "segments", "state", F.col("state").isin(*t.final).alias("valid"))


def parse_chats(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Read format_chats' output back: conv_id, turns (role, text), loss_text, formatted, and the machine's state and valid."""
    t = template or Template()
    literal = lambda s: "\\Q" + s + "\\E"
    split = F.split("formatted", literal(t.open))
    pieces = F.slice(split, F.lit(2), F.greatest(F.size(split) - 1, F.lit(0)))
    turn = lambda p: F.struct(
        unescape(F.substring_index(p, t.header_end, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, t.header_end, -1), t.close, 1)).alias("text"),
    )
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return formatted.select("conv_id", F.transform(pieces, turn).alias("turns"), loss.alias("loss_text"), "formatted", "state", "valid")


def digest(parsed: DataFrame) -> DataFrame:
    """The contract's columns from what parse_chats read, then the machine's final state and whether it accepts."""
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "state",
        "valid",
    )
