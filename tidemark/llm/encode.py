"""Token ids of whole texts with public tokenizer files, with a bounded cache of words."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Words, and pieces of words, of a generation whose ids one task keeps; of the one before, those in use are taken over.
CACHED_WORDS = 250_000
_LATIN = re.compile("[ -~\u00a1-\u00ac\u00ae-\u00ff]+")
# Fixed value: how byte-level tokenizers of the leading-blank kind cut a text.
LEADING = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Byte-level tokenizers show a byte as the character of that number where it is printable, others, in order, from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_BLANK = chr(_SHOWN[32])
# White space before more of it or the end; what follows a class is found faster than alternatives.
_UNSAFE = re.compile(r"\s(?!\S)")


class Encoder:
    """Encodes texts as the tokenizer does, as bytes of little-endian unsigned 32-bit ids.

    Texts are cut only where the tokenizer itself always cuts, and the ids of each cut piece are kept:
    a tokenizer that drops white space cuts at every blank and line break; a byte-level one whose words own the blank
    before them cuts before single blanks and around single line breaks, and a text with runs of white space or white space at
    an end is encoded whole. A text that may hold one of the file's added tokens is encoded whole as well, and any other tokenizer
    encodes whole texts. The words of a batch are counted and joined as Arrow arrays, so Python sees each different one once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = sorted({form for t in added for form in (t, t.lower())})
        self.marks = {t[0] for t in self.added if t}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.style = self._style()
        self.split = self._splitter()

    def _style(self) -> str:
        def ids(text):
            return self._plain([text])[0]

        if ids("ab  cd\n ef") == ids("ab") + ids("cd") + ids("ef") and ids(" \n\t ") == b"":
            return "dropped"
        if ids("ab cd ef.\ngh 1") == ids("ab") + ids(" cd") + ids(" ef.") + ids("\n") + ids("gh") + ids(" 1") and ids(" cd") != ids("cd"):
            return "leading"
        return "whole"

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of single words. Words of Latin-1 letters, digits and signs go to the tokenizer's model piece by piece, others through all of it."""
        if not self.split:
            return self._plain(words)
        others = [w for w in words if not _LATIN.fullmatch(w)]
        found = dict(zip(others, self._plain(others)))
        return [found[w] if w in found else b"".join(map(self._piece, self.split(w))) for w in words]

    def _piece(self, piece: str) -> bytes:
        ids = self.parts.get(piece)
        if ids is None:
            ids = self.older_parts.get(piece)
            if ids is None:
                # Of the ASCII characters that come here the blank alone is shown as another one.
                shown = piece.replace(" ", _BLANK) if piece.isascii() else piece.encode().decode("latin-1").translate(_SHOWN)
                ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            self.parts[piece] = ids
        return ids

    def _splitter(self):
        """What cuts a Latin-1 word into the model's pieces as the tokenizer file says; None if the file has another form than the two known."""
        form = json.loads(self.tokenizer.to_str())
        steps = form["pre_tokenizer"] or {}
        steps = steps.get("pretokenizers", [steps])
        small = [n["type"] for n in (form["normalizer"] or {}).get("normalizers", [])]
        if form["model"]["type"] != "BPE" or steps[-1].get("type") != "ByteLevel" or steps[-1]["add_prefix_space"]:
            return None
        if self.style == "dropped" and len(steps) == 2 and steps[0]["type"] == "Split" and small == ["NFC", "Replace", "Lowercase"]:
            cut = regex.compile(steps[0]["pattern"]["Regex"])
            return lambda word: cut.findall(word.lower())
        if self.style == "leading" and len(steps) == 1 and steps[0]["use_regex"] and not form["normalizer"]:
            pieces = regex.compile(LEADING).findall
            # A blank and letters are one piece.
            return lambda word: (word,) if word.isascii() and word.removeprefix(" ").isalpha() else pieces(word)
        return None

    def _cuttable(self, text: str) -> bool:
        if self.style == "whole" or "\0" in text or (self.style == "leading" and (text[:1].isspace() or _UNSAFE.search(text))):
            return False
        if not any(mark in text for mark in self.marks):
            return True
        lower = text.lower()
        return not any(token in text or token in lower for token in self.added)

    def _cut(self, texts: list[str]) -> pa.ListArray:
        column = pa.array(texts, pa.large_string())
        if self.style == "dropped":
            return pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        return pc.split_pattern(pc.replace_substring(pc.replace_substring(column, " ", "\0 "), "\n", "\0\n\0"), "\0")

    def _known(self, words: list[str]) -> list[bytes]:
        if len(self.cache) > CACHED_WORDS:
            self.older, self.cache = self.cache, {}
        if len(self.parts) > CACHED_WORDS:
            self.older_parts, self.parts = self.parts, {}
        missing = [w for w in words if w not in self.cache]
        if self.older:
            again = {w: self.older[w] for w in missing if w in self.older}
            self.cache.update(again)
            missing = [w for w in missing if w not in again]
        if missing:
            self.cache.update(zip(missing, self._words(missing)))
        return list(map(self.cache.__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._cuttable(text) for text in texts]
        found = iter(self._joined([text for text, fits in zip(texts, cut) if fits]))
        whole = iter(self._plain([text for text, fits in zip(texts, cut) if not fits]))
        return [next(found) if fits else next(whole) for fits in cut]

    def _joined(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        lists = self._cut(texts)
        coded = lists.flatten().dictionary_encode()
        ids = self._known(coded.dictionary.to_pylist())
        # A batch has fewer ids than bytes, so places fit 32 bits.
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        word = coded.indices.to_numpy()
        size = sizes[word]
        ends = np.cumsum(size, dtype=np.int32)
        # Place of every id of the batch among the ids of the different words.
        place = np.repeat(starts[word] - (ends - size), size)
        place += np.arange(len(place), dtype=np.int32)
        flat = np.frombuffer(b"".join(ids), "<u4")[place]
        bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [flat[begin:end].tobytes() for begin, end in zip(bounds[:-1], bounds[1:])]
