"""Ids of the words of a lower-casing BPE file that drops white space, quickly and as the library gives them.

A word is a stretch of UTF-8 bytes without ASCII white space. Such a file never joins characters across
white space, so the ids of a text are those of its words, one after the other.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from string import punctuation
from struct import pack

from deskmatch.llm.bpe import Cached, tokenizer

#: fixed values: the end-of-word mark of such files, and how they cut words
WORD_END = "</w>"
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Latin letters whose lower case is one letter and which composition leaves alone
LETTERS = "À-ÖØ-öø-įı-ňŊ-ſ"
PLAIN = re.compile(f"[!-~{LETTERS}]*")
#: CUTS for lower-case words of PLAIN characters
PLAIN_CUTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[^a-z0-9{LETTERS}]+")
#: a byte that no UTF-8 text holds stands for the end of a word
END_BYTE = b"\xff"
MARKS = punctuation.encode()


@lru_cache(maxsize=4)
def drops_spaces(path: str) -> bool:
    """Whether the file cuts at white space and drops it, so that texts may be encoded word by word."""
    with open(path, encoding="utf-8") as file:
        known = json.load(file)
    steps = (known.get("pre_tokenizer") or {}).get("pretokenizers") or [known.get("pre_tokenizer") or {}]
    first = steps[0]
    cut = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    added = any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in known.get("added_tokens", []))
    by_word = cut and (first.get("pattern") or {}).get("Regex") == CUTS
    return bool(by_word or first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")) and not added


def _byte_of() -> dict[str, int]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _pieces(path: str) -> dict[bytes, int]:
    """Bytes of every piece of the vocabulary with its id; the end of a word is END_BYTE."""
    with open(path, encoding="utf-8") as file:
        known = json.load(file)
    added, byte_of = {t["id"] for t in known["added_tokens"]}, _byte_of()
    table = {}
    for piece, i in known["model"]["vocab"].items():
        if i not in added:
            ended = piece.endswith(WORD_END)
            raw = bytes(byte_of[c] for c in (piece.removesuffix(WORD_END) if ended else piece))
            table[raw + END_BYTE if ended else raw] = i
    return table


@lru_cache(maxsize=4)
def ranks_suffice(path: str) -> bool:
    """Whether merging the pair of lowest id first gives the ids of the file, so that a rank encoder may stand in.

    The file has to normalise and cut as this module does, its ids to be single bytes, single bytes at a word's
    end, and then merges in their order. An end mark that is a symbol of its own and merges before all else is the
    same model; if there every piece encodes to itself, a piece is only ever made of the pair of its merge.
    """
    with open(path, encoding="utf-8") as file:
        known = json.load(file)
    model, steps = known["model"], (known.get("normalizer") or {}).get("normalizers", [])
    if (
        not drops_spaces(path) or [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]
        or model.get("end_of_word_suffix") != WORD_END or model.get("unk_token") or model.get("dropout")
        or known["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": CUTS}
        or known["pre_tokenizer"]["pretokenizers"][1:] != [
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
    ):
        return False
    from tokenizers.models import BPE

    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    merged = [model["vocab"].get("".join(pair), -1) for pair in pairs]
    singles = set(_byte_of())
    if [i for i in merged if i < 2 * len(singles)] or any(a >= b for a, b in zip(merged, merged[1:])):
        return False
    mark = "\u0000"
    marked = {p.removesuffix(WORD_END) + mark if p.endswith(WORD_END) else p: i for p, i in model["vocab"].items()}
    if not all(marked.get(c + mark, -1) == marked[c] + len(singles) for c in singles):
        return False
    marked[mark] = len(marked) + max(marked.values())
    ends = [(c, mark) for c in sorted(singles)]
    twin = BPE(marked, ends + [tuple(p.removesuffix(WORD_END) + mark if p.endswith(WORD_END) else p for p in pair) for pair in pairs])
    added = {t["content"] for t in known["added_tokens"]}
    return all([t.id for t in twin.tokenize(piece)] == [i] for piece, i in marked.items() if piece not in added)


class PieceIds(dict):
    """Ids of the pieces (lower-case UTF-8 bytes) that a word is cut into."""

    def __init__(self, path: str, limit: int, code: str):
        super().__init__()
        import tiktoken

        self.limit, self.code = limit, code
        self.ranks = tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=_pieces(path), special_tokens={})

    def __missing__(self, piece: bytes) -> bytes:
        found = self.ranks._encode_single_piece(piece + END_BYTE)
        ids = pack(f"<{len(found)}{self.code}", *found)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids


class LowerWords(Cached):
    """Ids of words (UTF-8 bytes) as unsigned integers of two bytes, or of four for a large vocabulary.

    With ``by_rank``, the answer of :func:`ranks_suffice`, words of plain characters go through a rank encoder.
    """

    def __init__(self, path: str, limit: int = 300_000, by_rank: bool = False):
        super().__init__(limit)
        self.tokenizer = tokenizer(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = re.compile("|".join(re.escape(t.content) for t in added.values()) or r"(?!)")
        self.pieces = PieceIds(path, limit, self.code) if by_rank else None

    def found(self, key: bytes) -> bytes:
        if self.pieces is not None:
            letters = key.rstrip(MARKS)
            if letters.isalpha():  # ASCII letters, then marks or nothing
                ids = self.pieces[letters.lower()]
                return ids + self.pieces[key[len(letters):]] if len(letters) < len(key) else ids
            word = key.decode()
            if PLAIN.fullmatch(word) and not self.special.search(word):
                return b"".join([self.pieces[cut.encode()] for cut in PLAIN_CUTS.findall(word.lower())])
        ids = self.tokenizer.encode(key.decode(), add_special_tokens=False).ids
        return pack(f"<{len(ids)}{self.code}", *ids)

    def text_ids(self, text: bytes) -> bytes:
        """All ids of a text."""
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def worker_words(path: str, by_rank: bool) -> LowerWords:
    """One cache for each worker process, kept over its tasks."""
    return LowerWords(path, by_rank=by_rank)
