"""Chat arrays and their rendering to text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .numeric import as_col

# Texts that every stage must share to see the same format.
SYSTEM_PROMPT = "You are a helpful assistant that summarizes text with the same voice as the author."
INSTRUCTION = "Summarize the following post:"
PREVIEW_CHARS = 100
#: The instruction as a decoder gives it, with a blank between tokens.
DECODED_INSTRUCTION = INSTRUCTION.replace(":", " :")


@dataclass(frozen=True)
class ChatTemplate:
    """Markers around one turn; the defaults are the common im_start/im_end form."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"

    @property
    def decoded_cue(self) -> str:
        """What is left of the end of turn and the cue when a decoder drops the markers."""
        return "\nassistant\n"

    @property
    def cue(self) -> str:
        return f"{self.start}assistant\n"

    def turn(self, role: Column, content: Column) -> Column:
        """One turn; markers inside its content are broken, so content cannot open or close a turn."""
        return F.concat(F.lit(self.start), role, F.lit("\n"), self.escape(content), F.lit(f"{self.end}\n"))

    def render(self, chat: Column | str, *, add_cue: bool = False) -> Column:
        turns = F.transform(as_col(chat), lambda m: self.turn(m["role"], m["content"]))
        text = F.array_join(turns, "")
        return F.concat(text, F.lit(self.cue)) if add_cue else text

    def escape(self, content: Column | str) -> Column:
        """Break markers inside user content so they cannot open or close a turn."""
        out = as_col(content)
        for marker in (self.start, self.end):
            out = F.replace(out, F.lit(marker), F.lit(f"{marker[:1]} {marker[1:]}"))
        return out


DEFAULT_TEMPLATE = ChatTemplate()


def user_prompt(prompt: Column | str) -> Column:
    return F.concat(F.lit(f"{INSTRUCTION}\n"), as_col(prompt))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_array(prompt: Column | str, answer: Column | str | None = None) -> Column:
    """system, user and (when ``answer`` is given) assistant turns.

    A NULL prompt or answer makes the whole array NULL: a missing text is never
    rendered as an empty turn.
    """
    turns = [message("system", F.lit(SYSTEM_PROMPT)), message("user", user_prompt(prompt))]
    present = as_col(prompt).isNotNull()
    if answer is not None:
        turns.append(message("assistant", as_col(answer)))
        present = present & as_col(answer).isNotNull()
    return F.when(present, F.array(*turns))


def extract_post(
    query: Column | str, *, marker: str = INSTRUCTION, mode: str = "first_line", template: ChatTemplate = DEFAULT_TEMPLATE
) -> Column:
    """The post inside a query, raw or decoded.

    No marker: the whole text. Marker with a newline: what follows the first one, up to the next such marker, up to the
    template's end of turn, and up to the next newline in ``first_line`` mode. In ``full`` mode a text that has lost the template's
    markers ends with the bare assistant cue, which goes too, once.
    Marker without a newline: NULL, which scoring turns into the default reward.
    """
    if mode not in ("first_line", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    q = as_col(query)
    full, end = F.lit(f"{marker}\n"), F.lit(template.end)
    rest = F.split_part(q, full, F.lit(2))
    turn = F.split_part(rest, end, F.lit(1))
    if mode == "first_line":
        after = F.split_part(turn, F.lit("\n"), F.lit(1))
    else:
        after = F.when(F.contains(rest, end), turn)
        for cue in (template.decoded_cue, template.decoded_cue.rstrip("\n")):
            after = after.when(F.endswith(rest, F.lit(cue)), F.substring(rest, F.lit(1), F.length(rest) - len(cue)))
        after = after.otherwise(rest)
    return (
        F.when(F.contains(q, full), after)
        .when(F.contains(q, F.lit(marker)), F.lit(None).cast("string"))
        .otherwise(q)
    )


def completion_tail(full: Column | str, prompt: Column | str) -> Column:
    """What follows the decoded prompt in a decoded completion, trimmed."""
    f, p = as_col(full), as_col(prompt)
    return F.btrim(F.substring(f, F.length(p) + 1, F.length(f)), F.lit(" \n\t\r"))


def preview(text: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    return F.concat(F.left(as_col(text), F.lit(chars)), F.lit("..."))


def normalise(text: Column | str) -> Column:
    """Lower case, runs of blanks as one, trimmed: the form texts are compared in."""
    return F.btrim(F.lower(F.regexp_replace(as_col(text), "[ \\t\\n\\r]+", " ")), F.lit(" "))
