"""Token ids of whole texts, with a bounded memo of chunks per Python worker.

Texts of a corpus repeat most of their words, so a tokenizer whose pre-tokens can never
cross certain places in a text needs to encode each chunk between such places only once:

* a byte-level tokenizer (no normaliser, GPT-2 pattern): every pre-token is one of
  `` ?letters``, `` ?digits``, `` ?others`` or white space, so a lone space between two
  characters that aren't white space always begins a new pre-token;
* the tokenizer whose normaliser and pre-tokenizer are ``WORDS`` below, which drops white
  space and doesn't compose across it: any space or line feed.

The ids come from the library in either case. Any other tokenizer, and one with an added
token that could stand inside a chunk of letters, gets each whole text: the fast paths are
taken only for the exact settings that they were written for.
"""

from __future__ import annotations

import json
import os
import re
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Chunks a worker remembers (about 200 bytes each). The first ones stay: in a corpus they
#: are the frequent ones; later ones are forgotten after their batch once the memo is full.
MEMO_CHUNKS = 500_000
#: Where a space doesn't stand alone between characters that aren't white space.
_ODD_SPACE = re.compile(r"\A\s| \s|[\s\x1c-\x1f\x85] | \Z|[\u180e\u200b\u2060\ufeff] | [\u180e\u200b\u2060\ufeff]")
#: The settings of the tokenizer files that the fast paths are for.
WORDS = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
BYTES = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
#: Byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b if b in _SHOWN else 256 + sum(x not in _SHOWN for x in range(b)) for b in range(256)}


def fast_mode(spec: dict) -> str:
    """``byte``, ``space`` or, for any file that isn't exactly as expected, ``whole``."""
    for token in spec.get("added_tokens") or []:
        content = token["content"]
        # neither white space, which parts chunks, nor letters, full stops and commas alone
        apart = any(not c.isalpha() and c not in ".," for c in content) and not re.search(r"\s", content)
        if not apart or token["lstrip"] or token["rstrip"] or token["single_word"]:
            return "whole"
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout"):
        return "whole"
    settings = (spec.get("normalizer"), spec.get("pre_tokenizer"))
    return "byte" if settings == BYTES else "space" if settings == WORDS else "whole"


def _latin_word(chunk: str) -> bool:
    """Letters only, all below U+0250 and with a lower case of one letter: normal in NFC and
    one pre-token for either kind of tokenizer."""
    return chunk.isalpha() and (chunk.isascii() or (max(chunk) < "\u0250" and "\u0130" not in chunk))


_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder of a tokenizer file, kept with its memo between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def largest_id(path: str) -> int:
    """The largest id of a tokenizer file's vocabulary, added tokens included."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size() - 1
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)


class Encoder:
    def __init__(self, path: str) -> None:
        self.first: dict[str, bytes] = {}   # chunk at the start of a text, or any chunk
        self.later: dict[str, bytes] = {}   # chunk after a space (byte-level only)
        self.mode = "whole"
        self.piece = None
        if path.endswith(".model"):
            import sentencepiece

            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.mode = fast_mode(spec)
        if self.mode != "whole":
            self.model = self.tokenizer.model
            self.marks = {m: array("I", ids).tobytes() for m, ids in zip(".,", self._encode([".", ","]))}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        if self.piece is not None:
            return self.piece.encode(texts, num_threads=1)
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, chunk: str, lead: str) -> bytes:
        """Ids of one pre-token of Latin letters, straight from the library's BPE model."""
        text = lead + (chunk if self.mode == "byte" else chunk.lower())
        if lead or not text.isascii():
            text = text.encode().decode("latin-1").translate(_BYTES)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _learn(self, memo: dict[str, bytes], chunks: set[str], lead: str) -> None:
        """Encode the chunks that the memo lacks. A final full stop or comma after a letter
        is a pre-token of its own, so the word before it is looked up alone."""
        rest = []
        for c in chunks:
            if c not in memo:
                if _latin_word(c):
                    memo[c] = self._word(c, lead)
                elif c[-1:] in (".", ",") and _latin_word(c[:-1]):
                    word = memo.get(c[:-1])
                    memo[c] = (self._word(c[:-1], lead) if word is None else word) + self.marks[c[-1]]
                else:
                    rest.append(c)
        if rest:
            for c, ids in zip(rest, self._encode([lead + c for c in rest])):
                memo[c] = array("I", ids).tobytes()

    def _forget(self) -> None:
        for memo in (self.first, self.later):
            for _ in range(len(memo) - MEMO_CHUNKS):
                memo.popitem()

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit integers in native byte order."""
        if self.mode == "space":
            split = [t.replace("\n", " ").split(" ") for t in texts]
            self._learn(self.first, set().union(*split), "")
            out = [b"".join(map(self.first.__getitem__, c)) for c in split]
            self._forget()
            return out
        if self.mode == "byte":
            odd = [i for i, t in enumerate(texts) if _ODD_SPACE.search(t)]
            whole = dict(zip(odd, self._encode([texts[i] for i in odd])))
            split = [None if i in whole else t.split(" ") for i, t in enumerate(texts)]
            self._learn(self.first, {c[0] for c in split if c}, "")
            self._learn(self.later, set().union(*(c[1:] for c in split if c)), " ")
            out = [array("I", whole[i]).tobytes() if c is None
                   else self.first[c[0]] + b"".join(map(self.later.__getitem__, c[1:]))
                   for i, c in enumerate(split)]
            self._forget()
            return out
        return [array("I", ids).tobytes() for ids in self._encode(texts)]
