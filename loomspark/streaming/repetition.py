"""Repetition guard on growing generations."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from loomspark.operators.generated import RULES, TAIL, repeated_window

OUT = "gen_id string, verdict string, pos long, window string"
_CLOSE, _OPEN = ("</think>", "<channel|>"), ("<think>", "<|channel>thought")
#: Characters kept so that a tag split over two tokens is seen.
_TAG = 32


def _step(text: str, cut: int, past: bool, opened: bool, token: str) -> tuple[str, int, bool, bool]:
    """Append a token. cut: characters already dropped in front of text; past: the reasoning has ended; opened: it had begun."""
    joined = text + token
    edge = max(0, len(text) - _TAG)
    if "</think>" in joined[edge:]:
        at = joined.rindex("</think>") + len("</think>")
        joined, cut = joined[at:], cut + at
        past = True
    past = past or any(t in joined[edge:] for t in _CLOSE)
    opened = opened or any(t in joined[edge:] for t in _OPEN)
    drop = max(0, len(joined) - TAIL)
    return joined[drop:], cut + drop, past, opened


_WIDTH, _LEAST = min(w for w, _ in RULES), min(k for _, k in RULES)


def _may_repeat(text: str, new: int) -> bool:
    """Whether a window that ends in the last ``new`` characters can complete a rule: its last characters, as many as the shortest
    window has, then stand in the tail as often as the rule of fewest occurrences asks."""
    for end in range(max(_WIDTH, len(text) - new + 1), len(text) + 1):
        piece, seen, at = text[end - _WIDTH : end], 0, -1
        while seen < _LEAST and (at := text.find(piece, at + 1)) >= 0:
            seen += 1
        if seen >= _LEAST:
            return True
    return False


def first_repetition(state: tuple[str, str, int, bool, bool], tokens: Iterator[tuple[str, str]], dialect: str) -> tuple[tuple, tuple[int, str] | None]:
    """State after some tokens (content, reasoning), and the repetition that the first token to complete one completes.

    The state is the tail of the reasoning, the tail of the content, the characters dropped in front (``fields``: all characters), and
    whether the reasoning has ended and had begun. Each token is judged alone, so it does not matter how a stream is cut into batches.
    """
    thought, text, cut, past, opened = state
    for content, reasoning in tokens:
        if dialect == "tags":
            text, cut, past, opened = _step(text, cut, past, opened, content)
            grown, new, front = text, len(content), cut
        else:  # reasoning stands in front of the content, whichever comes first
            thought, text, cut = (thought + reasoning)[-TAIL:], (text + content)[-TAIL:], cut + len(content) + len(reasoning)
            past, opened = past or bool(content), opened or bool(reasoning)
            grown = (thought + text)[-TAIL:]
            new, front = len(grown) if reasoning and text else len(content) + len(reasoning), cut - len(grown)
        if _may_repeat(grown, new):
            found = repeated_window(grown, RULES, TAIL)
            if found:
                return (thought, text, cut, past, opened), (front + found[0], found[1])
    return (thought, text, cut, past, opened), None


class _Guard(StatefulProcessor):
    """State of a generation: its pieces of text as lists that grow at the end, a row of flags, and whether it has ended.

    What counts of a list is its last characters, as many as the flags say, so a batch appends what came and writes nothing anew; a list
    is cut when it has twice what can count. An ended generation keeps its mark alone, with a time to live; one without
    tokens for that long is forgotten by a timer.
    """

    def __init__(self, dialect: str, timeout: int | None):
        self.dialect, self.timeout = dialect, timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.flags = handle.getValueState("flags", "cut long, past boolean, opened boolean, text long, text_held long, thought long, thought_held long")
        self.pieces = {k: handle.getListState(k, "piece string") for k in ("text", "thought")}
        self.ended = handle.getValueState("ended", "yes boolean", self.timeout)

    def _forget(self) -> None:
        for state in (self.flags, *self.pieces.values()):
            state.clear()
        for timer in list(self.handle.listTimers()) if self.timeout else ():
            self.handle.deleteTimer(timer)

    def _read(self, name: str, counts: int) -> str:
        return "".join(x[0] for x in self.pieces[name].get())[-counts:] if counts else ""

    def _grow(self, name: str, added: list[str], now: str, held: int) -> int:
        """Append what came; the characters that the list then holds."""
        new = "".join(added)
        if held + len(new) > 2 * TAIL + len(now):
            self.pieces[name].put([(now,)])
            return len(now)
        if new:
            self.pieces[name].appendValue((new,))
        return held + len(new)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if self.ended.exists():
            for _ in rows:
                pass
            if self.timeout:
                self.ended.update((True,))  # its time begins again
            return
        came = pd.concat(list(rows)).sort_values("seq", kind="stable")
        content = [c if isinstance(c, str) else "" for c in came["token"]]
        reasoning = [r if isinstance(r, str) else "" for r in came["reasoning"]] if self.dialect == "fields" else [""] * len(came)
        cut, past, opened, text_n, text_held, thought_n, thought_held = self.flags.get() if self.flags.exists() else (0, False, False, 0, 0, 0, 0)
        state = (self._read("thought", thought_n), self._read("text", text_n), cut, past, opened)
        (thought, text, cut, past, opened), found = first_repetition(state, zip(content, reasoning, strict=True), self.dialect)
        if found:
            self._forget()
            self.ended.update((True,))
            yield pd.DataFrame({"gen_id": [str(key[0])], "verdict": ["thinking" if opened and not past else "response"], "pos": [found[0]], "window": [found[1]]})
            return
        text_held = self._grow("text", content, text, text_held)
        thought_held = self._grow("thought", reasoning, thought, thought_held)
        self.flags.update((cut, past, opened, len(text), text_held, len(thought), thought_held))
        if self.timeout:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (self.flags, *self.pieces.values()):
            state.clear()
        yield from ()

    def close(self) -> None:
        pass


def repetition_guard(tokens: DataFrame, timeout: str | None = "1 hour", dialect: str = "tags") -> DataFrame:
    """Stream of tokens (gen_id, seq, token) to one row for each generation whose tail repeats: gen_id, verdict (thinking or
    response), pos (in the whole output), window. The first find ends a generation; later tokens of it are ignored.

    Dialect ``tags``: reasoning and response stand in one text, with tags between. ``fields``: tokens also have ``reasoning``, and what is
    judged is all reasoning with all content behind it.

    Tokens are taken by seq within a micro-batch and judged one by one, so the outcome does not depend on how they are cut into batches; a
    generation without tokens for ``timeout`` is forgotten. None keeps all, which a run over what is there now needs: with a timeout
    the stream goes on for its sake. State is in RocksDB: a session that still has Spark's default store gets that one, for the
    streaming queries it starts from then on.
    """
    if dialect not in ("tags", "fields"):
        raise ValueError(f"unknown dialect {dialect!r}")
    conf = tokens.sparkSession.conf
    if "HDFSBacked" in conf.get("spark.sql.streaming.stateStore.providerClass"):
        conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    guard = _Guard(dialect, _milliseconds(timeout) if timeout else None)
    return tokens.groupBy("gen_id").transformWithStateInPandas(guard, OUT, "append", "ProcessingTime" if timeout else "None")


def _milliseconds(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"second": 1_000, "minute": 60_000, "hour": 3_600_000}[unit.rstrip("s")]
