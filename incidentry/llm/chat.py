"""Chat formatting into token-budgeted windows with a loss mask.

Running sums of the turns' tokens choose turn-aligned spans, while the sorted
turns stream by: a task holds a window and its history, never a conversation.
Each window opens with the conversation's system turn, repeats a limited
history, and goes on with new turns. Only new assistant turns carry loss, so each target is trained
on once. Control strings inside texts are escaped, reversibly.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A turn is <|role|>, its text and <|end|>. Every < and & of a text is escaped, so no control string
# of this or of a common template can be read out of a text.
END = "<|end|>"
_TURN = re.compile(r"<\|([^|]*)\|>([^<]*)<\|end\|>")
_ROLE = {"%": "%25", "|": "%7C", "<": "%3C"}

WINDOW_BYTES = 4 << 20  # formatted text of a batch of windows

WINDOWS = (
    "id {kind}, window int, text string, n_tokens bigint, turns array<struct<"
    "turn:int,role:string,start:int,end:int,kind:string>>"
)


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace("[", "&#91;")


def unescape(text: str) -> str:
    return text.replace("&#91;", "[").replace("&lt;", "<").replace("&amp;", "&")


def escape_role(role: str) -> str:
    return re.sub(r"[%|<]", lambda m: _ROLE[m[0]], role)


def unescape_role(role: str) -> str:
    return re.sub(r"%(25|7C|3C)", lambda m: chr(int(m[1], 16)), role)


@dataclass(frozen=True)
class Budget:
    """Tokens (words and marks) in a window, and at most how many of them repeat earlier turns."""

    window: int = 1024
    history: int = 256


def count_tokens(text: str) -> int:
    """Runs of letters and digits, and other characters that are not white space; two marks a turn."""
    return len(re.findall(r"\w+|[^\w\s]", text)) + 2


class Conversation:
    """The windows of a conversation whose turns come one by one: (text, tokens, marks of its turns).

    A window takes new turns as long as they fit beside the system turn and the
    repeated history, and one at least: a turn beyond the budget stands whole.
    A mark is (turn, role, start, end, kind): the escaped text's place in code
    points, and whether it is the ``system`` turn repeated at the head,
    ``repeated`` history, or ``new``.
    """

    def __init__(self, budget: Budget):
        self.budget = budget
        self.turns = self.windows = 0
        self.head: list[tuple] = []  # the system turn, if any; turns are (number, role, text, tokens)
        self.room = budget.window
        self.past: deque[tuple] = deque()  # the latest turns that fit into the history
        self.new: deque[tuple] = deque()
        self.past_tokens = self.new_tokens = 0

    def add(self, role: str, text: str):
        """Take a turn; the windows that it completes."""
        turn = (self.turns, role, text, count_tokens(text))
        self.turns += 1
        if turn[0] == 0 and role == "system":
            self.head = [turn]
            self.room -= turn[3]
            return
        self.new.append(turn)
        self.new_tokens += turn[3]
        while self.new_tokens > self.room and len(self.new) > 1:
            yield self._window()

    def close(self):
        """The windows of what is left."""
        while self.new or (self.head and not self.windows):
            yield self._window()

    def _window(self):
        past = list(self.past)
        used = self.past_tokens
        if self.new and used + self.new[0][3] > self.room:  # the history leaves no room: go without it
            past, used = [], 0
        taken = []
        while self.new and (not taken or used + self.new[0][3] <= self.room):
            taken.append(self.new.popleft())
            used += taken[-1][3]
            self.new_tokens -= taken[-1][3]
        for turn in taken:
            self.past.append(turn)
            self.past_tokens += turn[3]
            while self.past_tokens > self.budget.history:
                self.past_tokens -= self.past.popleft()[3]
        members = [(t, "system" if self.windows else "new") for t in self.head]
        members += [(t, "repeated") for t in past] + [(t, "new") for t in taken]
        self.windows += 1
        parts, marks, at = [], [], 0
        for (number, role, text, _), kind in members:
            open_mark, body = f"<|{escape_role(role)}|>", escape(text)
            marks.append((number, role, at + len(open_mark), at + len(open_mark) + len(body), kind))
            parts += [open_mark, body, END]
            at += len(open_mark) + len(body) + len(END)
        return "".join(parts), sum(t[3] for t, _ in members), marks


def format_conversation(roles: list[str], texts: list[str], budget: Budget):
    """The windows of a conversation, as ``Conversation`` gives them."""
    talk = Conversation(budget)
    for role, text in zip(roles, texts, strict=True):
        yield from talk.add(role, text)
    yield from talk.close()


def same_key(one, other) -> bool:
    """Whether neighbours of a sorted frame are of one group; null and NaN are groups of their own."""
    return one == other or (one != one and other != other)


def format_chats(
    turns: DataFrame,
    budget: Budget = Budget(),
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per window: id, window, text, n_tokens and the marks of its turns.

    Turns go in the order of turn, then role, then text (nulls first, null role
    and text are empty); repeated rows are turns of their own. Rows with a null
    conversation are one conversation. An empty table gives no window. A
    conversation is dealt to one task, which reads its turns in order, since each
    window begins where the one before ends, but holds no more than a window of them.
    """
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        talk, key, kind_of_id, out, size = None, None, None, [], 0
        for batch in batches:
            kind_of_id = batch.schema.field("id").type
            columns = (batch.column(c).to_pylist() for c in ("id", "role", "text"))
            for own, role, text in zip(*columns, strict=True):
                done = []
                if talk is not None and not same_key(own, key):
                    done = [(key, w) for w in _numbered(talk, talk.close())]
                    talk = None
                if talk is None:
                    talk, key = Conversation(budget), own
                for line in (*done, *((key, w) for w in _numbered(talk, talk.add(role, text)))):
                    out.append(line)
                    size += len(line[1][1])
                    if size > WINDOW_BYTES:
                        yield _batch(out, kind_of_id)
                        out, size = [], 0
        if talk is not None:
            out += [(key, w) for w in _numbered(talk, talk.close())]
            yield _batch(out, kind_of_id)

    return dealt.mapInArrow(run, WINDOWS.format(kind=kind))


def _numbered(talk: Conversation, windows) -> Iterator[tuple]:
    for window in windows:
        yield (talk.windows - 1, *window)


_MARKS = pa.list_(
    pa.struct(
        [("turn", pa.int32()), ("role", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]
    )
)


def _batch(lines: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    marks = [[dict(zip(("turn", "role", "start", "end", "kind"), m, strict=True)) for m in w[3]] for _, w in lines]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key for key, _ in lines], kind), pa.array([w[0] for _, w in lines], pa.int32()),
            pa.array([w[1] for _, w in lines], pa.string()), pa.array([w[2] for _, w in lines], pa.int64()),
            pa.array(marks, _MARKS),
        ],
        ["id", "window", "text", "n_tokens", "turns"],
    )


def read_window(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]
