"""Token ids of whole texts by a public tokenizer, each distinct word of a block encoded once.

The tokenizer drops white space and never joins what white space separates, so the ids of a
text are those of its words in order. Arrow splits a block of texts and numbers its distinct
words; only these are looked up in the worker's bounded cache or else encoded by the tokenizers
library, which stays the only source of ids.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

from lakeline.llm.arrow import slices_of

#: Units whose ids one worker keeps at most, about 200 bytes each.
CACHE_WORDS = 150_000
#: Bytes of text whose distinct units are encoded together.
BLOCK_BYTES = 4_000_000

#: Letters and then ASCII that makes a pre-token of its own: no digits, quotes (which begin a
#: pre-token like 's), or brackets and bars of special tokens. The last letter must be one that
#: stays a single letter in the tokenizer's normal form; others may end in a mark there.
_LETTERS_THEN_MARKS = (r"^(\pL*[a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])"
                       r"""([!"#$%&()*+,\-./:;=?@[\\\]^_`{}~]+)$""")
#: Letters that are composed already and whose lower case is the same everywhere: the Latin
#: ones up to U+017F, without the dotted capital I.
_PLAIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def broadcast_tokenizer(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The tokenizer's file as text; executors need no copy of it."""
    with open(path or default_tokenizer(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


class WordEncoder:
    """Ids as little-endian unsigned 32-bit integers, exactly those of the library.

    Used of the tokenizer: white space is only a separator, A-Z are lowered, a run of letters
    is one pre-token, and it goes to the merge model as the characters that stand for its
    bytes. A sample of words is compared when it is loaded.
    """

    def __init__(self, description: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(description)
        self.model = self.tokenizer.model
        # Our cache is before the model's own, which would only cost time.
        self.model._resize_cache(0)
        self.cache_words = cache_words
        self.known: dict[str, bytes] = {}
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled: dict[int, str] = {}
        for char in map(chr, range(0x80, 0x800)):
            self.spelled.update(zip(char.encode(), spell.pre_tokenize_str(char)[0][0]))
        probe = ["the", "Thing", "\u00c9l\u00e8ve", "\u0151r", "\u017fo", ";-)", "x1"]
        whole = self.tokenizer.encode(" \n".join(probe), add_special_tokens=False).ids
        if np.asarray(whole, "<u4").tobytes() != b"".join(self.encode_units(probe)):
            raise ValueError("this tokenizer does not take words as assumed")

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of texts without white space, little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(units)
        plain, tokenize, spelled = _PLAIN.fullmatch, self.model.tokenize, self.spelled
        other = []
        for i, unit in enumerate(units):
            if plain(unit):
                if not unit.isascii():
                    unit = unit.lower().encode().decode("latin-1").translate(spelled)
                else:
                    unit = unit.lower()
                out[i] = array("I", [token.id for token in tokenize(unit)]).tobytes()
            else:
                other.append(i)
        found = self.tokenizer.encode_batch_fast([units[i] for i in other],
                                                 add_special_tokens=False)
        for i, one in zip(other, found):
            out[i] = array("I", one.ids).tobytes()
        return out

    def unit_ids(self, units: list[str]) -> list[bytes]:
        """The same from the cache, where it has them. A full cache keeps what it has:
        frequent units are met early, and rare ones are encoded again when they come again."""
        ids = list(map(self.known.get, units))
        gaps = [i for i, one in enumerate(ids) if one is None]
        for i, one in zip(gaps, self.encode_units([units[i] for i in gaps])):
            ids[i] = one
        for i in gaps[:max(0, self.cache_words - len(self.known))]:
            self.known[units[i]] = ids[i]
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        flat, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for block in unit_blocks(texts):
            ids = self.unit_ids(block.units)
            lengths = np.fromiter(map(len, ids), np.int32, len(ids)) >> 2
            at, stops = gathered(lengths, block.which)
            flat.append(np.frombuffer(b"".join(ids), "<u4")[at])
            counts.append(np.diff(np.append(0, stops)[block.ends], prepend=0))
        return np.concatenate(flat), np.concatenate(counts)


def gathered(lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values of the chosen lists, when lists of these lengths stand one after
    the other; and how many values there are up to the end of each chosen list."""
    starts = np.cumsum(lengths, dtype=np.int32) - lengths
    chosen = lengths[which]
    stops = np.cumsum(chosen, dtype=np.int32)
    at = np.repeat(starts[which] - (stops - chosen), chosen)
    at += np.arange(len(at), dtype=np.int32)
    return at, stops


def with_end(flat: np.ndarray, counts: np.ndarray,
             end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with the end id after those of each text, if there is one."""
    if end_id is None:
        return flat, counts
    out = np.empty(len(flat) + len(counts), np.uint32)
    ends = np.cumsum(counts + 1) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[ends], out[inner] = end_id, flat
    return out, counts + 1


class UnitBlock(NamedTuple):
    """Some texts' distinct units, the number of each unit of the texts among them, and how
    many units there are up to the end of each text."""

    units: list[str]
    which: np.ndarray
    ends: np.ndarray


def unit_blocks(texts: pa.Array) -> Iterator[UnitBlock]:
    """The texts, null as empty, in blocks of ``BLOCK_BYTES`` or one longer text.

    Units are words that ASCII white space parts (other white space is left to the tokenizer);
    a word of letters and marks after them is two. A-Z is lowered, as the tokenizer does, so
    that more units are alike.
    """
    texts = _valid(pc.fill_null(texts, ""))
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).tolist()
    for part in slices_of(sizes, BLOCK_BYTES):
        lists = pc.ascii_split_whitespace(_lowered(texts[part]))
        words = lists.flatten().dictionary_encode()
        parted = pc.ascii_split_whitespace(pc.replace_substring_regex(
            words.dictionary, _LETTERS_THEN_MARKS, r"\1 \2"))
        units = parted.flatten().dictionary_encode()
        at, stops = gathered(np.diff(parted.offsets.to_numpy()).astype(np.int32),
                             words.indices.to_numpy())
        ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        yield UnitBlock(units.dictionary.to_pylist(), units.indices.to_numpy()[at],
                        np.append(0, stops)[ends])


def _valid(texts: pa.Array) -> pa.Array:
    """Bytes that are no UTF-8, which a cast from binary may leave, become the mark for that."""
    try:
        texts.validate(full=True)
        return texts
    except pa.ArrowInvalid:
        raw = texts.cast(pa.binary()).to_pylist()
        return pa.array([t.decode("utf-8", "replace") for t in raw], pa.string())


def _lowered(texts: pa.Array) -> pa.Array:
    """A-Z lowered, but not in texts where that could change what the tokenizer makes of them:
    with combining marks, which it composes first, or the beginning of a special token."""
    lowered = pc.ascii_lower(texts)
    raw = texts.cast(pa.binary())
    marks = [pc.match_substring(raw, m) for m in (b"<|", b"\xcc", b"\xcd")]
    odd = pc.or_(pc.or_(marks[0], marks[1]), marks[2])
    return pc.if_else(odd, texts, lowered) if pc.any(odd).as_py() else lowered


_encoders: dict[str, WordEncoder] = {}


def encoder(description: Broadcast) -> WordEncoder:
    """The worker's encoder for this tokenizer, kept from task to task."""
    key = hashlib.md5(description.value.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(description.value)
    return _encoders[key]
