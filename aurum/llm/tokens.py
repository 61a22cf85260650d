"""Exact token ids by a unit cache over the ``tokenizers`` library.

Both public vocabularies split a text before merging, and never merge across
the place where a run of blanks begins, nor between a Latin word and one
punctuation mark that a blank follows.  So a text is cut into units there (by
Arrow, a batch at a time), each distinct unit goes through the library once,
and a text's ids are the ids of its units in order.  Words repeat, so almost
every unit is a cache hit.  Texts with unusual white space or added-token
markers go through the library whole; so do all texts of other vocabularies.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark owns the cores

#: White space beyond ASCII's blanks, control characters some engines count as such, markers.
_ODD = "[\x1c-\x1f\x85   -     　]|<\\|"
#: Blanks that a cut at single spaces would split wrongly.
_RUNS = r"\A |\A\n| \z|\n\z|[ \n\t\r\x0b\x0c][ \n\t\r\x0b\x0c]|[\t\r\x0b\x0c]"
_UNIT = re.compile(r"\s*\S+|\s+", re.ASCII)
#: One punctuation mark between a Latin word's end and a blank is a pretoken by itself.
_MARK = "([0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])( |\\z)"
_MARK_BLANK = "([0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])([ \\t\\n\\r\\x0b\\x0c]|\\z)"
#: Small Latin letters that no normalising changes, and words of them with ASCII marks behind.
_LETTERS = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN = re.compile(rf"([a-z{_LETTERS}]*)([!-/:-@\[-`{{-~]*)")
#: Beyond this, lower-casing may differ between libraries.
_NOT_LATIN = "[İƀ-\U0010ffff]"
#: Stands before a piece that has no space before it in the text (texts that hold it are odd).
_GLUE = "\x1f"


class UnitEncoder:
    """Encode batches of texts with a bounded cache.

    ``max_units`` bounds the cached units (of at most 64 characters); beyond it
    the cache starts anew, which costs time but changes no result.
    """

    def __init__(self, path: str, max_units: int = 900_000) -> None:
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.max_units = max_units
        normal, before = repr(self.tok.normalizer), repr(self.tok.pre_tokenizer)
        self.drops_blanks = "Lowercase" in normal and "Removed" in before
        self.keeps_blanks = normal == "None" and before.startswith("ByteLevel(")
        added = sorted(self.tok.get_added_tokens_decoder().items())
        self.mark_id, self.mark = (added[0][0], added[0][1].content) if added else (None, None)
        self.model, self.shown, self.plain = self.tok.model, {}, False
        if self.drops_blanks:
            for c in _LETTERS:  # how the model is shown the bytes of a letter
                self.shown[ord(c)] = "".join(x for x, _ in self.tok.pre_tokenizer.pre_tokenize_str(c))
            probe = [_LETTERS, "".join(map(chr, range(97, 123))) + "'!", "s''", "é_", "*[~"]
            whole = self.tok.encode(" ".join(probe), add_special_tokens=False).ids
            self.plain = whole == [i for u in probe for i in self._plain(u)]
        self._reset()

    def _reset(self) -> None:
        self.codes: dict[str, int] = {}
        self.n = self.used = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.len = np.zeros(1 << 14, np.int64)

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        out = np.zeros(max(n, len(a) * 3 // 2), a.dtype)
        out[:len(a)] = a
        return out

    def _plain(self, unit: str) -> list[int] | None:
        """Ids of a small Latin word and marks after it, which normalising leaves
        as they are and splitting parts where the marks begin, from the library's
        model.  None for other units."""
        if not (parts := _PLAIN.fullmatch(unit)):
            return None
        word, marks = parts.groups()
        ids = [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.shown))] if word else []
        return ids + [t.id for t in self.model.tokenize(marks)] if marks else ids

    def _library(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each unit."""
        if not self.plain:
            return self._marked(units)
        ids = [self._plain(u) for u in units]
        if rest := [i for i, x in enumerate(ids) if x is None]:
            some, n = self._marked([units[i] for i in rest])
            ends = np.cumsum(n).tolist()
            for i, a, b in zip(rest, [0, *ends], ends):
                ids[i] = some[a:b].tolist()
        return np.array([i for x in ids for i in x], np.uint32), np.array([*map(len, ids)], np.int64)

    def _marked(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_library`` by whole encoding.  Many units go in one call with an
        added token between them, which the library splits at first."""
        if self.mark is None or any("<|" in u for u in units):
            ids = [e.ids for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]
            return (np.fromiter((i for x in ids for i in x), np.uint32),
                    np.fromiter(map(len, ids), np.int64, len(ids)))
        ids = np.array(self.tok.encode_batch_fast([self.mark.join(units)],
                                                  add_special_tokens=False)[0].ids, np.uint32)
        at = np.concatenate([[-1], np.flatnonzero(ids == self.mark_id), [len(ids)]])
        return ids[ids != self.mark_id], np.diff(at) - 1

    def _learn(self, units: list[str], each: int = 256) -> np.ndarray:
        """Store the ids of units; their codes."""
        first = self.n
        self.n += len(units)
        self.start, self.len = self._grown(self.start, self.n), self._grown(self.len, self.n)
        code = first
        for at in range(0, len(units), each):
            ids, n = self._library(units[at:at + each])
            self.flat = self._grown(self.flat, self.used + len(ids))
            self.flat[self.used:self.used + len(ids)] = ids
            self.start[code:code + len(n)] = self.used + np.cumsum(n) - n
            self.len[code:code + len(n)] = n
            code, self.used = code + len(n), self.used + len(ids)
        return np.arange(first, self.n)

    def _lookup(self, units: list[str]) -> np.ndarray:
        """Codes of distinct units; unknown ones are learnt."""
        get = self.codes.get
        code = np.array([get(u, -1) for u in units], np.int64)
        new = np.flatnonzero(code < 0)
        if len(new):
            fresh = [units[i] for i in new.tolist()]
            code[new] = got = self._learn(fresh)
            self.codes.update((u, c) for u, c in zip(fresh, got.tolist()) if len(u) <= 64)
        return code

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(codes, number per text) of texts that can be cut by Arrow alone."""
        if self.drops_blanks:
            high = pc.match_substring_regex(texts, _NOT_LATIN)
            low = pc.if_else(high, texts, pc.utf8_lower(texts))
            lists = pc.ascii_split_whitespace(pc.replace_substring_regex(low, _MARK_BLANK, r"\1 \2\3"))
        else:
            cut = pc.replace_substring(texts, "\n", f" {_GLUE}\n {_GLUE}")
            lists = pc.split_pattern(
                pc.replace_substring_regex(cut, _MARK, rf"\1 {_GLUE}\2\3"), " ")
        n = np.diff(lists.offsets.to_numpy())
        if not self.drops_blanks and len(n):  # a text's first piece has no space before it
            pieces = lists.flatten()
            first = np.zeros(len(pieces), bool)
            first[np.cumsum(n) - n] = True
            pieces = pc.if_else(pa.array(first), pc.binary_join_element_wise(_GLUE, pieces, ""),
                                pieces)
        else:
            pieces = lists.flatten()
        d = pieces.dictionary_encode()
        units = d.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not self.drops_blanks:
            units = [u[1:] if u[:1] == _GLUE else " " + u for u in units]
        return self._lookup(units)[d.indices.to_numpy()], n

    def encode(self, texts: pa.Array | Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another as uint32, number of ids per text)."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(list(texts), pa.string())
        texts = pc.fill_null(texts, "")
        if self.n > self.max_units:
            self._reset()
        full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        if self.drops_blanks or self.keeps_blanks:
            odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False) & full
        else:
            odd = full.copy()
        runs = np.zeros(len(full), bool) if self.drops_blanks else (
            pc.match_substring_regex(texts, _RUNS).to_numpy(zero_copy_only=False) & full & ~odd)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, codes, codes per row
        if (plain := np.flatnonzero(full & ~odd & ~runs)).size:
            parts.append((plain, *self._cut(texts.take(pa.array(plain)))))
        if (some := np.flatnonzero(runs)).size:
            lists = [_UNIT.findall(texts[i].as_py()) for i in some]
            units = {u: i for i, u in enumerate(dict.fromkeys(u for x in lists for u in x))}
            code = self._lookup(list(units))
            parts.append((some, code[[units[u] for x in lists for u in x]],
                          np.array([len(x) for x in lists], np.int64)))
        kept = self.n, self.used
        if (whole := np.flatnonzero(odd)).size:  # not cached
            parts.append((whole, self._learn([texts[i].as_py() for i in whole], 1),
                          np.ones(len(whole), np.int64)))
        per = np.zeros(len(full), np.int64)
        for rows, _, n in parts:
            per[rows] = n
        first = np.cumsum(per) - per
        code = np.zeros(int(per.sum()), np.int64)
        for rows, codes, n in parts:
            code[np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(len(codes))] = codes
        n = self.len[code]
        upto = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=upto[1:])
        at = np.repeat(self.start[code] - upto[:-1], n)
        at += np.arange(len(at))
        ids = self.flat[at]
        self.n, self.used = kept
        return ids, np.diff(upto[np.concatenate([[0], np.cumsum(per)])])


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """This worker's encoder; its cache serves all tasks the worker runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def slices(texts: pa.Array, max_bytes: int = 6_000_000) -> Iterable[tuple[int, int]]:
    """Cut an array of texts into slices [a, b) of about ``max_bytes``, so that
    memory does not follow the size of an Arrow batch."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(upto):
        b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + max_bytes)) + 1
        yield a, min(b, len(upto))
        a = b
