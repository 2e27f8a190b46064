"""Whole texts to token ids with a public tokenizer file, piece by piece.

``word_bpe_49k.json`` lower-cases, drops white space, parts letters, digits and marks,
and encodes each such piece by itself. A block's texts are parted into pieces with
array operations, equal pieces are grouped, and only a group is looked up: each worker
remembers the ids of pieces that it has met, and new ones go to the tokenizers library,
runs of letters many at a time. That covers ASCII and the Latin-1 letters; a word
(between ASCII white space) with anything else in it, with an apostrophe, a control
character or a special token goes to the library as a whole. A tokenizer file whose
normalizer, pre-tokenizer or model differ is applied to whole texts instead.
"""

from __future__ import annotations

import json
import os

import numpy as np

from retention.llm.words import Runs

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces a worker remembers (about 250 bytes each: this is most of what it holds), the longest one it does, and
#: letters sent to the library at a time.
REMEMBERED, LONGEST, AT_A_TIME = 300_000, 48, 5_000

#: What of a tokenizer file makes pieces independent: fixed values of the public file.
BY_PIECE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
SPACE, LETTER, MARK, DIGIT, ODD = range(5)
#: Kind of each byte below 128 (an apostrophe and control characters are odd), and lower case.
_KIND = np.array([SPACE if c == 32 or 9 <= c <= 13 else ODD if c < 32 or c == 39 or c >= 127 else DIGIT if 48 <= c <= 57
                  else LETTER if chr(c).isalpha() else MARK for c in range(256)], np.uint8)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Recent:
    """Remembers the latest half to whole of ``limit`` keys, and any that are still in use."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def put(self, pairs) -> None:
        if len(self.new) > self.limit // 2:
            self.new, self.old = {}, self.new
        self.new.update(pairs)

    def older(self, keys) -> dict:
        """Those of ``keys`` that only the older half knows, which now count as new."""
        found = {k: self.old[k] for k in keys if k in self.old}
        self.put(found)
        return found


class WordEncoder:
    """``encode`` gives the little-endian unsigned 32-bit ids of each text."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.by_piece = (all(conf.get(k) == v for k, v in BY_PIECE.items()) and not conf.get("truncation")
                         and conf["model"].get("end_of_word_suffix") == "</w>" and not conf["model"].get("dropout")
                         and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or " " in t["content"] for t in conf["added_tokens"]))
        self.special = [t["content"].encode() for t in conf["added_tokens"]]
        self.ends_word = np.zeros(max([0, *conf["model"]["vocab"].values()]) + 1, bool)
        self.ends_word[[i for t, i in conf["model"]["vocab"].items() if t.endswith("</w>")]] = True
        self.pieces, self.odd = Recent(remembered), Recent(remembered // 8)

    def _library(self, parts: list[bytes]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast([x.decode("utf-8") for x in parts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in out]

    def _letters(self, parts: list[bytes]) -> list[bytes]:
        """Ids of runs of letters: each is one piece, which ends with the id that ends a word."""
        out = []
        for lo in range(0, len(parts), AT_A_TIME):
            some = parts[lo:lo + AT_A_TIME]
            ids = np.array(self.tokenizer.encode_batch_fast([b"\n".join(some).decode("utf-8")], add_special_tokens=False)[0].ids, "<u4")
            cuts = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            flat = ids.tobytes()
            out += [flat[4 * s:4 * e] for s, e in zip([0, *cuts], cuts)] if len(cuts) == len(some) else self._library(some)
        return out

    @staticmethod
    def _known(memory: Recent, parts: list[bytes], encode) -> list[bytes]:
        """Ids of different strings, by ``encode`` where the memory has none."""
        ids = list(map(memory.new.get, parts))
        gaps = [i for i, x in enumerate(ids) if x is None]
        if gaps:
            need = [parts[i] for i in gaps]
            found = memory.older(need)
            fresh = [w for w in need if w not in found]
            made = dict(zip(fresh, encode(fresh)))
            memory.put((w, x) for w, x in made.items() if len(w) <= LONGEST)
            made.update(found)
            for i in gaps:
                ids[i] = made[parts[i]]
        return ids

    def _pieces(self, parts: list[bytes]) -> list[bytes]:
        letters = [(x[0] > 127 or x[:1].isalpha()) for x in parts]
        out = dict(zip(w := [x for x, yes in zip(parts, letters) if yes], self._letters(w)))
        out.update(zip(w := [x for x, yes in zip(parts, letters) if not yes], self._library(w)))
        return [out[x] for x in parts]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_piece:
            return self._library(texts)
        text = b" " + b" ".join(texts) + b" " * 9
        buf, low = np.frombuffer(text, np.uint8), np.frombuffer(text.translate(_LOWER), np.uint8).copy()
        kind = _KIND[buf]
        lead = np.flatnonzero(buf == 0xC3)  # of U+00C0 to U+00FF: all letters but two
        second = buf[lead + 1]
        letter = (second != 0x97) & (second != 0xB7)
        kind[lead[letter]] = kind[lead[letter] + 1] = LETTER
        low[lead[letter & (second <= 0x9E)] + 1] += 0x20
        # Words that need the library: their bytes become one odd piece each.
        inside = kind != SPACE
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edge[0::2], edge[1::2]
        odd = np.flatnonzero(kind == ODD)
        for special in self.special:
            at = text.find(special)
            while at >= 0:
                odd = np.append(odd, at)
                at = text.find(special, at + 1)
        odd = np.unique(np.searchsorted(starts, odd, "right") - 1)
        change = np.zeros(len(kind) + 1, np.int8)
        change[starts[odd]], change[ends[odd]] = 1, -1
        kind[np.cumsum(change[:-1], dtype=np.int8).view(bool)] = ODD
        # Pieces: runs of one kind, and each digit.
        edge = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) + 1
        begins = kind[edge] != SPACE
        begins[-1:] = False
        at = np.flatnonzero(begins)
        starts, ends = edge[at], edge[at + 1]
        is_odd = kind[starts] == ODD
        plain = np.flatnonzero(~is_odd)
        runs = Runs(low.tobytes(), starts[plain], ends[plain])
        group = np.empty(len(starts), np.int64)
        group[plain] = runs.groups()
        ids = self._known(self.pieces, runs.strings(), self._pieces)
        number: dict[bytes, int] = {}
        group[is_odd] = [number.setdefault(text[s:e], len(ids) + len(number)) for s, e in zip(starts[is_odd].tolist(), ends[is_odd].tolist())]
        ids += self._known(self.odd, list(number), self._library)
        # Every piece's ids one after the other.
        size = np.array([len(x) for x in ids], np.int64) // 4
        first = np.cumsum(size) - size
        n = size[group]
        upto = np.cumsum(n)
        flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(first[group] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)].tobytes()
        bounds = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]) + 1)
        cuts = (4 * np.concatenate(([0], upto))[np.concatenate(([0], bounds))]).tolist() if texts else [0]
        return [flat[s:e] for s, e in zip(cuts, cuts[1:])]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
