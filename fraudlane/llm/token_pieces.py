"""Byte-level BPE given as a tokenizers JSON, encoded by its rank table.

A byte-level vocabulary whose merges are listed in the order of their ids is a rank table, and tiktoken's
encoder of a rank table is some times faster than the library of the JSON. Special strings, which that library
takes as their ids by default, are cut out of a text before.
"""

from __future__ import annotations

import json
import re
from array import array


def _byte_letters() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PieceEncoder:
    """Encodes texts as the ``tokenizers`` library does with a byte-level BPE given as its JSON, special strings included.
    A JSON of another kind is left to the library, which then encodes whole texts."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        self.library = self.special = None
        known = self._ranks(spec)
        if known is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(tokenizer_json)
            if self.library.get_vocab_size() > 1 << 16:
                raise ValueError("token ids are kept in two bytes: at most 65,536 of them")
            return
        import public_tokenizers
        import tiktoken

        if max(known.values()) >= 1 << 16:
            raise ValueError("token ids are kept in two bytes: at most 65,536 of them")
        self.ordinary = tiktoken.Encoding("json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}).encode_ordinary
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if self.added:
            self.special = re.compile("|".join(re.escape(s) for s in sorted(self.added, key=len, reverse=True)))

    @staticmethod
    def _ranks(spec: dict) -> dict[bytes, int] | None:
        """The rank table of a byte-level vocabulary whose merges are listed in the order of their ids; else None."""
        model, before, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                 and not before.get("add_prefix_space") and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
                 and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")))
        if not plain:
            return None
        names, letters = {t["content"] for t in added}, _byte_letters()
        tokens = {t: k for t, k in model["vocab"].items() if t not in names}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if len(tokens) != 256 + len(merges) or any(tokens.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        return {bytes(letters[c] for c in t): k for t, k in tokens.items()}

    def encode(self, text: str) -> bytes:
        """The token ids of the whole text, two bytes each, little endian."""
        if self.library is not None:
            return array("H", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        out, at = array("H"), 0
        for found in self.special.finditer(text) if self.special else ():
            out.extend(self.ordinary(text[at:found.start()]))
            out.append(self.added[found[0]])
            at = found.end()
        out.extend(self.ordinary(text[at:]))
        return out.tobytes()

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 2


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(tokenizer_json: str, version: str) -> PieceEncoder:
    """One encoder for each tokenizer version and Python worker."""
    if version not in _ENCODERS:
        _ENCODERS[version] = PieceEncoder(tokenizer_json)
    return _ENCODERS[version]
