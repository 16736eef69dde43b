"""All places of many names in texts: an Aho-Corasick automaton over whole Arrow batches.

One pass over a text finds every name of a part of the lexicon, however many there are.  The rest is done for a whole
batch at once with numpy: word borders, names that overlap themselves, and the lists of spans.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK = 1 << 20  # characters that are looked through at once
_BREAK = "\x00"


def fold(text: str) -> str:
    """Lower case, a character for a character: those whose lower case is longer stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c in text for x in (c.lower(),))


def _word_table() -> np.ndarray:
    """Which characters count as parts of words: letters, marks, digits, connectors and joiners."""
    out = np.zeros(0x110000, bool)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        out[i] = kind[0] in "LM" or kind in ("Nd", "Nl", "Pc") or i in (0x200C, 0x200D)
    return out


_tables: list[np.ndarray] = []


def is_word(codes: np.ndarray) -> np.ndarray:
    if not _tables:
        _tables.append(_word_table())
    return _tables[0][codes]


def overlaps_itself(name: str) -> bool:
    """Whether some proper beginning of the name is its end, too."""
    border = [0] * len(name)
    for i in range(1, len(name)):
        k = border[i - 1]
        while k and name[i] != name[k]:
            k = border[k - 1]
        border[i] = k + (name[i] == name[k])
    return bool(name) and border[-1] > 0


class Names:
    """Distinct folded names as an automaton; whole names only where they hold neither a space nor a parenthesis."""

    def __init__(self, names: list[str]):
        self.machine = ahocorasick.Automaton()
        for i, name in enumerate(names):
            if name:
                self.machine.add_word(name, i)
        self.machine.make_automaton()
        self.size = np.array([len(n) for n in names], np.int64)
        self.loose = np.array([" " in n or "(" in n for n in names], bool)
        self.folds = np.array([overlaps_itself(n) for n in names], bool)

    def find(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """text, name and start of every place, by text, name and start; places of one name in a text don't overlap."""
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        whole = _BREAK.join(texts) + _BREAK
        found = list(self.machine.iter(fold(whole))) if len(self.machine) else []
        if not found:
            return (np.zeros(0, np.int64),) * 3
        end, name = np.array(found, np.int64).T
        first = end + 1 - self.size[name]
        text = np.searchsorted(starts, first, "right") - 1
        ok = end < starts[text + 1] - 1  # a name with the break in it could run over
        word = is_word(np.frombuffer(whole.encode("utf-32-le"), "<u4"))
        before = np.concatenate([[False], word[:-1]])
        ok &= self.loose[name] | ((word[first] != before[first]) & (word[end] != word[end + 1]))
        text, name, first = text[ok], name[ok], first[ok]
        order = np.lexsort((first, name, text))
        text, name, first = text[order], name[order], first[order]
        again = np.flatnonzero((text[1:] == text[:-1]) & (name[1:] == name[:-1]) & (first[1:] < first[:-1] + self.size[name[:-1]])) + 1
        if len(again):
            keep, last = np.ones(len(first), bool), {}
            for i in np.flatnonzero(self.folds[name]).tolist():
                key = (int(text[i]), int(name[i]))
                keep[i] = first[i] >= last.get(key, -1)
                if keep[i]:
                    last[key] = int(first[i] + self.size[name[i]])
            text, name, first = text[keep], name[keep], first[keep]
        return text, name, first - starts[text]


_built: dict[str, Names] = {}


def pack_names(entries: list[tuple[int, str, str]]) -> tuple:
    """What searcher() shares, of entries (number, entity type, name)."""
    by_name: dict[str, list[int]] = {}
    for at, (_, _, name) in enumerate(entries):
        by_name.setdefault(fold(name), []).append(at)
    number, types, names = (list(x) for x in zip(*entries, strict=True)) if entries else ([], [], [])
    return uuid.uuid4().hex, list(by_name), list(by_name.values()), np.array(number, np.int32), pa.array(types, pa.string()), pa.array(names, pa.string())


def searcher(shared, kinds: pa.Schema):
    """A mapInArrow function over doc_id, passage_idx, u_start and text, of what pack_names() made."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, folded, entries, number, types, names = shared.value
        if key not in _built:  # one for each Python worker, as long as its tasks search the same names
            _built.clear()
            _built[key] = Names(folded)
        machine = _built[key]
        own_first = np.cumsum([0, *map(len, entries)])
        own = np.fromiter((e for x in entries for e in x), np.int64, int(own_first[-1]))
        for batch in batches:
            texts, a = batch.column("text"), 0
            size = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            while a < len(texts):  # a chunk's texts alone are Python's, not the batch's
                b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + _CHUNK, "right")))
                text, name, first = machine.find([t or "" for t in texts[a:b].to_pylist()])
                if len(text):
                    yield _rows(batch.slice(a, b - a), text, name, first, machine.size, own_first, own, number, types, names, kinds)
                a = b

    return search


def _rows(batch, text, name, first, size, own_first, own, number, types, names, kinds) -> pa.RecordBatch:
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (name[1:] != name[:-1])]))
    start = first + batch.column("u_start").to_numpy(zero_copy_only=False)[text]
    spans = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(start + size[name], pa.int32())], ["s", "e"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(text)), pa.int32()), spans)
    # a name may be several entries: other types, other cases
    entries = np.diff(own_first)[name[new]]
    group = np.repeat(np.arange(len(new)), entries)
    entry = own[own_first[name[new]][group] + np.arange(len(group)) - np.repeat(np.cumsum(entries) - entries, entries)]
    rows = pa.array(text[new][group])
    columns = [batch.column(c).take(rows) for c in ("doc_id", "passage_idx")]
    columns += [types.take(pa.array(entry)), pa.array(number[entry]), names.take(pa.array(entry)), lists.take(pa.array(group))]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)
