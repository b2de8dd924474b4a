"""Token ids of whole texts by the tokenizers library, a run of characters at a time.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, so
the ids of the runs, in order, are the ids of the text. Each distinct run is
encoded by the library once per cache filling.

* ``byte_bpe`` files (byte-level, white space kept): runs are white space and
  the other characters after it. No match of the split pattern starts in
  other characters and ends in white space, and its only look-around looks to
  the right. A run that starts with Latin letters, after one space or line end
  or none, and goes on with an ASCII mark is cut before the mark, and one of a
  line end and such letters after the line end.
* ``word_bpe`` files (white space dropped): runs are the characters between
  white space.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

from .common import Memo, load_tokenizer, per_worker

# The characters of \s in the tokenizers' patterns (Unicode White_Space).
WHITE = "\t-\r \x85\xa0  -     　"
#: White space for str.split() but not for the tokenizers.
SEPARATORS = "\x1c\x1d\x1e\x1f"
DROPS_SPACE = re.compile(f"[^{WHITE}]+")
#: Latin letters that are one code point in composed form; ASCII marks end any run of letters.
LETTERS, MARKS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", "!-/:-@\\[-`{-~"
ALONE = f"[{LETTERS}]++(?![^{WHITE}{MARKS}])"
KEEPS_SPACE = re.compile(f" ?{ALONE}|\n(?={ALONE})|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
HEAD = re.compile(f"([{LETTERS}]+)([{MARKS}].*)", re.DOTALL)
WORD = re.compile(f" ?[{LETTERS}]+")
#: Distinct runs kept by a worker.
CACHE_RUNS = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(shifted)) for b in range(256)]


def split_words(text: str) -> list[str]:
    """The runs between the tokenizers' white space."""
    if any(c in text for c in SEPARATORS):
        return DROPS_SPACE.findall(text)
    return text.split()


def keeps_space(tokenizer) -> bool:
    """Whether white space has ids of its own in this tokenizer."""
    return bool(tokenizer.encode("a  a", add_special_tokens=False).ids
                != tokenizer.encode("a a", add_special_tokens=False).ids)


def make_encoder(name_or_path: str) -> Callable[[str], bytes]:
    """``text -> ids`` as native unsigned 32-bit integers, without special tokens added.

    A run of Latin letters before an ASCII mark is looked up by itself (they
    are different pre-tokens in any context); a run that is one pre-token of
    such letters goes to the library's model directly; any other run goes
    through the library's whole pipeline.
    """
    tokenizer = load_tokenizer(name_or_path)
    model, symbols = tokenizer.model, byte_symbols()
    space, others = symbols[32], dict(enumerate(symbols))

    def run_ids(run: str) -> bytes:
        if WORD.fullmatch(run):
            mapped = run.replace(" ", space) if run.isascii() else run.encode().decode("latin-1").translate(others)
            return array("I", [t.id for t in model.tokenize(mapped)]).tobytes()
        return array("I", tokenizer.encode(run, add_special_tokens=False).ids).tobytes()

    memo = Memo(run_ids, CACHE_RUNS)
    if keeps_space(tokenizer):
        look_up, runs_of = memo.__getitem__, KEEPS_SPACE.findall
        return lambda text: b"".join(map(look_up, runs_of(text)))

    def compound(run: str) -> bytes:
        """A run that is not in the cache."""
        cut = HEAD.fullmatch(run)
        if cut:
            return low(cut[1]) + memo[cut[2]]
        return low(run)

    def low(run: str) -> bytes:
        return memo[run.lower()] if WORD.fullmatch(run) else memo[run]

    def ids(runs: list[str]) -> bytes:
        get = memo.get
        return b"".join([get(r) or compound(r) for r in runs])

    return lambda text: ids(split_words(text))


def worker_encoder(name_or_path: str) -> Callable[[str], bytes]:
    return per_worker(("encoder", name_or_path), lambda: make_encoder(name_or_path))
