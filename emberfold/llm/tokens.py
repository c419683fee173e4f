"""Token ids of whole texts by a public tokenizer, with repeated words encoded once."""

from __future__ import annotations

import json
import os
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from emberfold.llm.worker import once

# Words remembered per Python worker, about 150 bytes each. Others are encoded
# again in each batch that has them; the ids are the same.
MEMO_WORDS = 250_000
# Words whose ids are gathered at a time.
_GATHER = 500_000
# Words given to the tokenizer at a time.
_ENCODE = 8_192
_POINTS = ",.;:!?"
# A space after white space: a cut before it could part what the tokenizer joins.
_JOINED = r"[\s\p{Z}\x{85}\x1c-\x1f] "


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _plain(word: str) -> bool:
    """Letters alone, of scripts that all Unicode versions agree on."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0530")


class Encoder:
    """Ids of whole texts, one array of unsigned 32-bit integers per text.

    A byte-level tokenizer never joins a space with a visible character before it,
    nor a letter with the punctuation after it. So texts are cut before such
    spaces, a batch's distinct words are looked up or encoded once, and the ids are
    gathered per text. Tokenizers of other kinds and texts with other white space
    or with an added token's string are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                     and not pre.get("add_prefix_space") and not spec.get("normalizer"))
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.words: dict[str, bytes] = {}
        # byte-level models know bytes as characters: printable ones as they are, the others
        # in order from 256 on
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in shown]
        self.table = {b: chr(256 + k) for k, b in enumerate(others)}

    def _encode(self, texts: list[str]) -> list[bytes]:
        # in slices: the library's own results are many times larger than the ids
        return [array("I", e.ids).tobytes() for k in range(0, len(texts), _ENCODE) for e in
                self.tokenizer.encode_batch_fast(texts[k:k + _ENCODE], add_special_tokens=False)]

    def _encode_words(self, words: list[str], before: str) -> list[bytes]:
        """Ids of each word with ``before`` in front; letters alone go straight to the model."""
        model, table = self.tokenizer.model.tokenize, self.table
        plain = [_plain(w) for w in words]
        rest = iter(self._encode([before + w for w, p in zip(words, plain) if not p]))
        space = before and table[32]
        return [array("I", [t.id for t in model(space + (
                    w if w.isascii() else w.encode().decode("latin-1").translate(table)))]).tobytes()
                if p else next(rest) for w, p in zip(words, plain)]

    def _spaced(self, words: list[str], often: np.ndarray) -> list[bytes]:
        """Ids of each distinct word with a space before it.

        Punctuation after letters is cut off, and so is the first word of the next line.
        Only words that came ``often``, more than once in the batch, are remembered.
        """
        known = self.words
        out = list(map(known.get, words))
        misses = [i for i, ids in enumerate(out) if ids is None]
        whole, rest, cuts = [], [], []
        for i in misses:
            word = words[i]
            if word.isalpha():
                whole.append(i)
                continue
            head, line, last = word.partition("\n")
            word = last.rstrip(_POINTS)
            if not (line and head and not head[-1].isspace() and _plain(word)):
                head, line, last, word = words[i], "", "", ""
            base = head.rstrip(_POINTS)
            if not (base and base[-1].isalpha()):
                base = head
            rest.append(i)
            cuts.append((base, head[len(base):] + line, word, last[len(word):]))
        need = list({c[0] for c in cuts}.difference(known).union([words[i] for i in whole]))
        fresh = dict(zip(need, self._encode_words(need, " ")))
        need = list({c[2] for c in cuts})
        begins = dict(zip(need, self._encode_words(need, "")))
        need = list({e for c in cuts for e in (c[1], c[3])})
        ends = dict(zip(need, self._encode(need)))
        for i in whole:
            out[i] = fresh[words[i]]
        for i, (base, end, word, last) in zip(rest, cuts):
            ids = fresh.get(base) or known[base]
            out[i] = ids + ends[end] + begins[word] + ends[last] if end or word else ids
        room = MEMO_WORDS - len(known)
        if room > 0:
            again = {words[i] for i in whole if often[i] > 1}
            again.update({c[0] for i, c in zip(rest, cuts) if often[i] > 1}.intersection(fresh))
            known.update((w, fresh[w]) for w in islice(again, room))
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """One array per text; a null counts as empty."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return []
        if not self.cuts:
            return [np.frombuffer(b, "<u4") for b in self._encode(texts.to_pylist())]
        whole = pc.match_substring_regex(texts, _JOINED)
        for added in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, added))
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy().copy()
        heads = offsets[:-1]
        begins = self._encode(
            coded.dictionary.take(coded.indices.take(pa.array(heads))).to_pylist())
        often = np.bincount(index, minlength=len(coded.dictionary))
        # by way of numpy, several times quicker than to_pylist
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        blobs = self._spaced(words, often) + begins
        index[heads] = np.arange(len(blobs) - len(begins), len(blobs))
        sizes = np.fromiter(map(len, blobs), np.int32, len(blobs)) // 4
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        ids = np.frombuffer(b"".join(blobs), "<u4")
        out, first = [], 0
        while first < len(heads):
            last = int(np.searchsorted(offsets, offsets[first] + _GATHER, "right")) - 1
            last = min(max(last, first + 1), len(heads))
            part = index[offsets[first]:offsets[last]]
            lengths = sizes[part]
            ends = np.cumsum(lengths, dtype=np.int64)
            at = np.repeat(starts[part] - (ends - lengths), lengths)
            at += np.arange(len(at))
            out += np.split(ids[at], ends[offsets[first + 1:last] - offsets[first] - 1])
            first = last
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            out[i] = np.frombuffer(self._encode([texts[int(i)].as_py()])[0], "<u4")
        return out


def encoder(path: str) -> Encoder:
    return once(("encoder", path), lambda: Encoder(path))
