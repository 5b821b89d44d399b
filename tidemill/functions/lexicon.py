"""Rewriting by a large ordered lexicon: an automaton finds the entries that a text holds, and only those are
applied, in order."""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lexicon_order


class _Fold(dict):
    """Characters as they are compared without case: upper case, then lower case, one for one."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        upper = c.upper()
        self[code] = out = (upper if len(upper) == 1 else c).lower()[0]
        return out


class _InWord(dict):
    """Whether a character is part of a word: letters, marks, digits, connectors, joiners."""

    def __missing__(self, c: str) -> bool:
        kind = unicodedata.category(c)
        self[c] = out = kind[0] in "LM" or kind in ("Nd", "Nl", "Pc") or c in "‌‍" or 0x24B6 <= ord(c) <= 0x24E9
        return out


class Rewriter:
    """Applies ordered entries to texts, each on the output of those before it.

    All entries are in one automaton (a trie with failure links).  A text is searched for all of them
    once; after an entry that changed it, only the surroundings of what was replaced are searched again, as far
    as an entry can reach from there.  So the work follows the text's length and its replacements, not the
    number of entries in it times its length."""

    def __init__(self, entries: Iterable[tuple[str, str]]):
        import ahocorasick

        self.fold, self.word = _Fold(), _InWord()
        self.entries = [(slang.translate(self.fold), standard, standard.translate(self.fold), word) for slang, standard, word in lexicon_order(entries) if slang]
        self.reach = max((len(slang) for slang, _, _, _ in self.entries), default=0)
        numbers: dict[str, list[int]] = {}
        for k, (slang, _, _, _) in enumerate(self.entries):
            numbers.setdefault(slang, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for slang, own in numbers.items():
            self.automaton.add_word(slang, (len(slang), all(map(self.word.__getitem__, slang)), tuple((k, self.entries[k][3]) for k in own)))
        if self.entries:
            self.automaton.make_automaton()

    def search(self, text: str, folded: str, begin: int, end: int, after: int, into: set[int]) -> None:
        """Adds the entries beyond a number that match in folded[begin:end]."""
        word, size = self.word, len(text)
        for last, (n, plain, own) in self.automaton.iter(folded[begin:end]):
            stop = last + begin + 1
            at = stop - n
            if plain:  # word characters only: a match ends where a word does
                edges = not (at > 0 and word[text[at - 1]] or stop < size and word[text[stop]])
            else:
                edges = self._edge(text, at) and self._edge(text, stop)
            for k, whole in own:
                if k > after and (edges or not whole):
                    into.add(k)

    def _edge(self, text: str, at: int) -> bool:
        return (at > 0 and self.word[text[at - 1]]) != (at < len(text) and self.word[text[at]])

    def apply(self, k: int, text: str, folded: str) -> tuple[str, str, list[tuple[int, int]]] | None:
        """The text with an entry's matches replaced from left to right, the same folded, and where the
        replacements stand in it; None where there is no match."""
        slang, standard, low, word = self.entries[k]
        kind, begins = self.word, word and self.word[slang[0]]
        out, lows, spans, begin, size, at = [], [], [], 0, 0, folded.find(slang)
        while at >= 0:
            end = at + len(slang)
            if word and (begins and at > 0 and kind[text[at - 1]] or not (self._edge(text, at) and self._edge(text, end))):
                at = folded.find(slang, at + 1)
                continue
            out += [text[begin:at], standard]
            lows += [folded[begin:at], low]
            size += at - begin + len(standard)
            spans.append((size - len(standard), size))
            begin = end
            at = folded.find(slang, end)
        return ("".join([*out, text[begin:]]), "".join([*lows, folded[begin:]]), spans) if out else None

    def rewrite(self, text: str) -> str:
        if not self.entries:
            return text
        folded = text.translate(self.fold)
        found: set[int] = set()
        self.search(text, folded, 0, len(folded), -1, found)
        left = list(found)
        heapq.heapify(left)
        while left:
            k = heapq.heappop(left)
            if (new := self.apply(k, text, folded)) is None:
                continue
            text, folded, spans = new
            more: set[int] = set()
            done = 0
            for begin, end in spans:  # matches that touch a replacement or stand right beside it
                begin, end = max(begin - self.reach, done - self.reach, 0), min(end + self.reach, len(folded))
                self.search(text, folded, begin, end, k, more)
                done = end
            for other in more - found:
                heapq.heappush(left, other)
            found |= more
        return text


def rewritten(c: Column, entries: Iterable[tuple[str, str]]) -> Column:
    """text.lexical() for a lexicon of any size: the plan has one node, and each worker builds the automaton
    once a task.  Null stays null.  Case is folded one character for one (the sharp s and its rare capital
    are one letter here, also where a regex takes them for two)."""
    held = tuple(entries)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Rewriter(held)
        for batch in batches:
            yield batch.map(lambda x: None if x is None else own.rewrite(x))

    return run(c)
