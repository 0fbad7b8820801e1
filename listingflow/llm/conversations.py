"""Repair of conversations: the cheapest edits after which turns alternate, streamed in turn order.

A conversation is the rows of one id by turn. A row's first fault counts: blank (nothing but white space), duplicate
(role and text of an earlier row), truncated (the last character that is no white space is none of ``.!?``). Edits
are Keep (0), Rerole to user or assistant (1), Delete (2) and Insert of an empty turn (5). Blank and duplicate rows must
go; a truncated row that stays costs 5 more. The initials of the roles that are left must read ``(s?(ua)+)?``.

Rows are repartitioned by conversation and sorted by turn, and the sorted rows stream through ``mapInPandas``. After each row
there are four states to be in: nothing yet, after a system turn, after a user, after an assistant. Carried from
batch to batch are only each state's cheapest cost, the order of their edit strings, and the digest of the text that
each would leave. Two strings that have dealt with the same rows differ at some place or are equal, so that their order is
known from the order before and the letters added, and ties go to the string that is least in ASCII without looking at
strings. Costs less their minimum, with that order, take few values; a step from one such vector to the next is
worked out once and has a number. The numbers are the backpointers: one for each row, spilled to the shared folder for
giant conversations and read from the end to write the edits.

A conversation is one stream by nature: its rows pass one task in sorted order, however many there are, and
the sort spills. The task holds none of them.

Defined cases: null roles and texts are one space, so such a row is blank or has no known role. Null turns come first
and do not count as gaps. Rows of one turn are taken by role and text. Null ids are one conversation. An initial is the first
character as it is, and an empty role has none. Gaps that no long can hold are the greatest long. Other columns are not
looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import cache, partial

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import work_path

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED_KEPT = 5
# Backpointers of a conversation that are held in memory, four bytes each.
HELD = 1 << 20
MAX_LONG = (1 << 63) - 1
_WHITE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
# The state in which an inserted or reroled turn leaves a conversation, and that turn's role.
_NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
_FIELDS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


@cache
def _edits(must_go: bool, truncated: bool, initial: str) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, letters) of all that can be done with a row of this kind."""
    found = []
    for state in range(4):
        for letters, cost, at in (("", 0, state), ("I", INSERT, _NEXT[state][0])):
            found.append((state, at, cost + DELETE, letters + "D"))
            if must_go:
                continue
            cost += TRUNCATED_KEPT if truncated else 0
            found.append((state, _NEXT[at][0], cost + REROLE, letters + "R"))
            if initial == "s" and at == START:
                found.append((state, SYSTEM, cost + KEEP, letters + "K"))
            elif initial in ("u", "a") and _NEXT[at][1].startswith(initial):
                found.append((state, _NEXT[at][0], cost + KEEP, letters + "K"))
    return tuple(found)


class Steps:
    """Numbered steps from one vector of (cost over the least, rank of its string) by state to the next."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.steps: list[tuple[tuple, int, dict[int, tuple[int, str]]]] = []

    def take(self, vector: tuple, kind: tuple[bool, bool, str]) -> int:
        number = self.numbers.get((vector, kind))
        if number is None:
            best: dict[int, tuple[int, int, str, int]] = {}
            for state, to, cost, letters in _edits(*kind):
                if vector[state] is not None:
                    way = (vector[state][0] + cost, vector[state][1], letters, state)
                    if to not in best or way < best[to]:
                        best[to] = way
            least = min(way[0] for way in best.values())
            order = sorted(best, key=lambda to: best[to][1:3])
            after = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))
            number = self.numbers[vector, kind] = len(self.steps)
            self.steps.append((after, least, {to: (way[3], way[2]) for to, way in best.items()}))
        return number


class _Pointers:
    """The step numbers of one conversation, the oldest of them in a file of the shared folder."""

    def __init__(self, folder: str, held: int):
        self.folder, self.limit = folder, held
        self.held, self.files = array("I"), []

    def add(self, number: int) -> None:
        self.held.append(number)
        if len(self.held) >= self.limit:
            store, root = fs.FileSystem.from_uri(self.folder)
            store.create_dir(root, recursive=True)
            path = f"{root}/{uuid.uuid4().hex}.steps"
            with store.open_output_stream(path) as out:
                out.write(self.held.tobytes())
            self.files.append(path)
            self.held = array("I")

    def backwards(self) -> Iterator[int]:
        yield from reversed(self.held)
        for path in reversed(self.files):
            store, _ = fs.FileSystem.from_uri(self.folder)
            with store.open_input_file(path) as source:
                numbers = array("I", source.read())
            store.delete_file(path)
            yield from reversed(numbers)


class _Conversation:
    """What is carried along the rows of one conversation."""

    def __init__(self, name, steps: Steps, folder: str, held: int):
        self.name, self.steps, self.pointers = name, steps, _Pointers(folder, held)
        self.vector: tuple = ((0, 0), None, None, None)
        self.texts = {START: hashlib.sha256()}
        self.begun = {START: False}
        self.cost = self.illegal = self.blank = self.duplicate = self.truncated = self.turns = 0
        self.first = self.last = self.initial = None

    def add(self, turn: str | None, role: str, text: str, fault: str) -> None:
        if turn is not None and (number := int(turn)) != self.last:
            self.first = number if self.first is None else self.first
            self.last = number
            self.turns += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.illegal += 1
        self.initial = initial
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        kind = (fault in ("blank", "duplicate"), fault == "truncated", initial if initial in ("s", "u", "a") else "")
        number = self.steps.take(self.vector, kind)
        self.vector, least, ways = self.steps.steps[number]
        self.cost += least
        self.pointers.add(number)
        texts, begun = {}, {}
        for to, (state, letters) in ways.items():
            out, some = self.texts[state].copy(), self.begun[state]
            for r, t in replay(letters, state, [(role, text)]):
                out.update((("\n" if some else "") + f"{r}:{t}").encode())
                some = True
            texts[to], begun[to] = out, some
        self.texts, self.begun = texts, begun

    def result(self) -> dict:
        ends = [(self.vector[s][0] + cost, self.vector[s][1], letters, s)
                for s, cost, letters in ((START, 0, ""), (ASSISTANT, 0, ""), (USER, INSERT, "I"))
                if self.vector[s] is not None]
        cost, _, letters, state = min(ends)
        text = self.texts[state]
        if letters:
            text.update(b"\nassistant:")
        written = [letters]
        for number in self.pointers.backwards():
            state, added = self.steps.steps[number][2][state]
            written.append(added)
        written.reverse()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {
            "conv_id": self.name, "gaps": min(gaps, MAX_LONG), "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost + cost,
            "audit": "".join(written), "repaired_sha256": text.hexdigest(),
        }


def replay(letters: str, state: int, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) that edits leave of ``rows``, which follow on ``state``."""
    left = iter(rows)
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter == "K" and role.startswith("s"):
            state = SYSTEM
        else:
            state, needed = _NEXT[state]
            role = role if letter == "K" else needed
        yield role, text


def _repaired(batches: Iterator[pd.DataFrame], folder: str, held: int) -> Iterator[pd.DataFrame]:
    steps, now = Steps(), None
    for batch in batches:
        done = []
        for name, turn, role, text, fault in zip(*(batch[c] for c in ("conv_id", "turn", "role", "text", "fault"))):
            if now is None or now.name != name:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(name, steps, folder, held)
            if fault != "gone":
                now.add(turn, role, text, fault)
        yield pd.DataFrame(done, columns=_COLUMNS)
    if now is not None:
        yield pd.DataFrame([now.result()], columns=_COLUMNS)


_COLUMNS = ["conv_id", *re.findall(r"(\w+) \w+", _FIELDS)]


def _sorted_turns(turns: DataFrame, gone: Column | None) -> DataFrame:
    """Rows with their first fault, by conversation, each conversation in order in one partition."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else gone).alias("gone"),
    ).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.asc_nulls_first("turn")))
    end = F.right(F.rtrim(F.col("text"), F.lit(_WHITE)), F.lit(1))
    fault = (
        F.when(F.col("gone"), "gone").when(end == "", "blank").when(F.col("seen") > 1, "duplicate")
        .when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    )
    return rows.withColumn("seen", seen).withColumn("fault", fault).sortWithinPartitions("conv_id", "turn", "role", "text")


def repairs(turns: DataFrame, gone: Column | None = None, held: int = HELD) -> DataFrame:
    """(conv_id, faults, cost, audit, repaired_sha256) of each conversation of (conv_id, turn, role, text).

    ``audit`` holds the cheapest edits' initials in order. A row where ``gone`` is true names its conversation and is
    otherwise not there.
    """
    kind = turns.schema["conv_id"].dataType
    run = partial(_repaired, folder=work_path(turns.sparkSession, "conversation-steps"), held=held)
    rows = _sorted_turns(turns, gone).select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"), "role", "text", "fault"
    )
    return rows.mapInPandas(run, f"conv_id string, {_FIELDS}").withColumn("conv_id", F.col("conv_id").cast(kind))


def _replayed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    name, audit, at, state, place = object(), "", 0, START, 0
    for batch in batches:
        out = []

        def put(role: str, text: str, edit: str) -> None:
            nonlocal state, place
            state = SYSTEM if edit == "K" and role.startswith("s") else _NEXT[state][0]
            out.append((name, place, role, text, edit))
            place += 1

        def inserts() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                put(_NEXT[state][1], "", "I")
                at += 1

        for conv, whole, role, text in zip(*(batch[c] for c in ("conv_id", "audit", "role", "text"))):
            if whole is not None:
                name, audit, at, state, place = conv, whole, 0, START, 0
                inserts()
                continue
            edit = audit[at]
            at += 1
            if edit != "D":
                put(role if edit == "K" else _NEXT[state][1], text, edit)
            inserts()
        yield pd.DataFrame(out, columns=["conv_id", "position", "role", "text", "edit"])


def repaired_turns(turns: DataFrame, found: DataFrame, gone: Column | None = None) -> DataFrame:
    """(conv_id, position, role, text, edit): the turns that the audits of ``found`` leave of ``turns``.

    Each audit travels to its conversation's rows and comes first among them.
    """
    kind = turns.schema["conv_id"].dataType
    rows = turns.where(~F.coalesce(gone, F.lit(False))) if gone is not None else turns
    text = F.lit(None).cast("string")
    listed = rows.select(
        "conv_id", text.alias("audit"), "turn", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).unionByName(found.select(
        "conv_id", "audit", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), text.alias("role"), text.alias("text")
    ))
    ordered = listed.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), "turn", "role", "text"
    )
    return ordered.select(F.col("conv_id").cast("string").alias("conv_id"), "audit", "role", "text").mapInPandas(
        _replayed, "conv_id string, position long, role string, text string, edit string"
    ).withColumn("conv_id", F.col("conv_id").cast(kind))
