"""Token ids of whole texts by a public word-level tokenizer, fast enough for a corpus.

The tokenizer drops white space and never joins characters across it, so a text's ids are those of its
white-space-free chunks in a row. A task keeps the ids of chunks it has met; new ones are encoded by the
tokenizer in one call per batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

WORD_TOKENIZER = "word_bpe_49k.json"
# Chunks of at most MAX_KEPT characters are kept, in two generations of CACHE_CHUNKS each.
CACHE_CHUNKS = 200_000
MAX_KEPT = 48
# Characters of text that are split and looked up at once.
BATCH_CHARS = 4_000_000

# Latin letters without combining marks, whose lower case is one character each, and ASCII without most controls.
_UNUSUAL = "[^\t-\r -~\u00a1-\u012f]"
# Controls that Python splits at and the tokenizer does not.
_CONTROLS = "\x1c\x1d\x1e\x1f"
# A sign beyond the Latin letters: the byte that it begins with is in no text that is looked up by the word.
_MARK = "\u4e2d"
# A run of these after letters is a piece of its own in any case.
_TAIL = ".,;:!?"


def tokenizer_path(name: str = WORD_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, one byte string per text.

    Equal to the tokenizer's own ids for the whole text, without special tokens. Null counts as empty.
    """

    def __init__(self, path: str):
        import numpy as np
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same merges without the search for pieces, for words of ASCII letters, which are one piece each.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _plain(self, chunks: list[str]) -> list[bytes]:
        import numpy as np

        encodings = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encodings]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of lower-case words of Latin letters, each of which is one piece whose last token alone closes a word."""
        found = self._closed([w for w in words if w.isascii()], self.merges)
        found.update(self._closed([w for w in words if not w.isascii()], self.tokenizer))
        return found

    def _closed(self, words: list[str], tokenizer) -> dict[str, bytes]:
        import numpy as np

        ids = np.array(tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1 if len(ids) else ids
        if len(ends) != len(words):
            return dict(zip(words, self._plain(words)))
        raw, starts = ids.tobytes(), [0, *(4 * ends[:-1]).tolist()]
        return {w: raw[a:b] for w, a, b in zip(words, starts, (4 * ends).tolist())}

    def _marked(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks of usual characters, found in one text with a mark between each two."""
        import numpy as np

        if not chunks:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([f" {_MARK} ".join(chunks)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == self.mark[0])
        if len(ends) != len(chunks) - 1:
            return self._plain(chunks)
        raw, ends = ids.tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *(e + 4 * len(self.mark) for e in ends)], [*ends, len(raw)])]

    def _learn(self, chunks: list[str], usual: bool) -> dict[str, bytes]:
        """Ids of new chunks; letters with punctuation behind them are looked up as two."""
        if not usual:
            return dict(zip(chunks, self._plain(chunks)))
        letters, tailed, others = [], [], []
        for c in chunks:
            if c.isalpha():
                letters.append(c)
            elif (core := c.rstrip(_TAIL)).isalpha():
                tailed.append((c, core, c[len(core):]))
            else:
                others.append(c)
        found = self._words(letters)
        known = {c: found.get(c) or self.new.get(c) or self.old.get(c) for c in {core for _, core, _ in tailed}}
        known.update(self._words([c for c, v in known.items() if not v]))
        tails = list({tail for *_, tail in tailed})
        tail_ids = dict(zip(tails, self._marked(tails)))
        found.update([(c, known[core] + tail_ids[tail]) for c, core, tail in tailed])
        found.update(zip(others, self._marked(others)))
        return found

    def _look_up(self, wanted: list[str], usual: bool = True) -> list[bytes]:
        """Ids of distinct chunks."""
        out = list(map(self.new.get, wanted))
        missing = [i for i, v in enumerate(out) if v is None]
        if not missing:
            return out
        chunks = [wanted[i] for i in missing]
        held = list(map(self.old.get, chunks))
        learned = self._learn([c for c, v in zip(chunks, held) if v is None], usual)
        held = [learned[c] if v is None else v for c, v in zip(chunks, held)]
        if len(self.new) + len(held) > CACHE_CHUNKS:
            self.old, self.new = self.new, {}
        self.new.update([(c, v) for c, v in zip(chunks, held) if len(c) <= MAX_KEPT])
        for i, v in zip(missing, held):
            out[i] = v
        return out

    def _rare(self, text: str) -> bytes:
        """A text with other characters: its chunks as they are, or the whole of it where they are unclear."""
        if any(c in text for c in _CONTROLS):
            return self._plain([text])[0]
        chunks = text.split()
        distinct = list(dict.fromkeys(chunks))
        ids = dict(zip(distinct, self._plain(distinct)))
        return b"".join([ids[c] for c in chunks])

    def encode(self, texts) -> Iterator[bytes]:
        """Ids of each text of an Arrow string array, about BATCH_CHARS characters at a time."""
        import numpy as np
        import pyarrow.compute as pc

        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + BATCH_CHARS)))
            yield from self._encode(texts.slice(at, end - at))
            at = end

    def _encode(self, texts) -> list[bytes]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        unusual = pc.match_substring_regex(texts, _UNUSUAL)
        lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.if_else(unusual, "", texts)))
        words = lists.flatten()
        coded = words.dictionary_encode()
        pieces = self._look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        starts, flat = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(pieces), "<u4")
        place = coded.indices.to_numpy()
        each = lengths[place]
        ends = np.cumsum(each)
        raw = flat[np.repeat(starts[place] - (ends - each), each) + np.arange(int(each.sum()))].tobytes()
        edges = np.concatenate([[0], ends])[np.cumsum(np.concatenate([[0], pc.list_value_length(lists).to_numpy()]))]
        edges = (4 * edges).tolist()
        out = [raw[a:b] for a, b in zip(edges, edges[1:])]
        for i in pc.indices_nonzero(unusual).to_pylist():
            out[i] = self._rare(texts[i].as_py())
        return out


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which serves one task after another."""
    kept = sys.__dict__.setdefault("_duolex_encoders", {})
    if path not in kept:
        kept.clear()
        kept[path] = WordEncoder(path)
    return kept[path]
