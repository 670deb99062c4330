"""What the operators that run public tokenizers share."""

from __future__ import annotations


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Bytes whose Latin-1 character prints stand for themselves, the others for the
    characters from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(moved)}


class Spelling(dict):
    """A character's bytes in the byte-level alphabet; for ``str.translate``."""

    def __init__(self):
        self.of_byte = {b: c for c, b in byte_alphabet().items()}

    def __missing__(self, code: int) -> str:
        self[code] = "".join(self.of_byte[b] for b in chr(code).encode())
        return self[code]


def plain_letters(tokenizer) -> str:
    """Latin letters, of both cases, that the tokenizer reads as a letter and lower-cases, if at all, one by one.

    Asked of the tokenizer itself, so that no Unicode table has to agree with its own.
    """
    out = []
    for c in map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)]):
        low = tokenizer.normalizer.normalize_str(c) if tokenizer.normalizer else c
        alone = len(low) == 1 and low in (c, c.lower())
        if alone and len(tokenizer.pre_tokenizer.pre_tokenize_str(f"a{low}b")) == 1:
            out.append(c)
    return "".join(out)


class Memo(dict):
    """What was met in a task: when it is full only what was used since the last time stays."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def __missing__(self, key):
        self[key] = value = self.old[key]
        return value

    def unknown(self, keys) -> list:
        return [k for k in keys if k not in self and k not in self.old]

    def tidy(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
