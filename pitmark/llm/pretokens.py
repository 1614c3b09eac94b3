"""Token ids of whole texts by the public byte-level BPE, once per Python worker."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

#: The vocabulary's special token: its string in a text is this one id.
SPECIAL = {"<|endoftext|>": 50256}


#: The characters that Unicode calls white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_LONG_WHITE = re.compile(f"[{WHITE}]{{5000,}}")


@lru_cache(maxsize=2)
def encoding(name: str = "byte_bpe_50k") -> tiktoken.Encoding:
    """The vocabulary as merge ranks; the tests hold it against the tokenizer file of the same name."""
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def ids(text: str, name: str = "byte_bpe_50k") -> np.ndarray:
    """Ids of the whole text, uint32.

    The pattern matcher gives up on very long runs of white space, so these are
    cut out first. Such a run is one pre-token: all of it at the end of the
    text or before a special token, else all but its last character, which
    belongs to what follows.
    """
    bpe, out, at = encoding(name), [], 0
    for m in _LONG_WHITE.finditer(text):
        stop = m.end() if m.end() == len(text) or text.startswith(tuple(SPECIAL), m.end()) else m.end() - 1
        out.append(bpe.encode_to_numpy(text[at : m.start()], allowed_special="all"))
        out.append(np.array(bpe._encode_single_piece(text[m.start() : stop]), np.uint32))
        at = stop
    rest = bpe.encode_to_numpy(text[at:] if at else text, allowed_special="all")
    return np.concatenate([*out, rest]) if out else rest


@lru_cache(maxsize=2)
def byte_lengths(name: str = "byte_bpe_50k") -> np.ndarray:
    """Bytes of the text that each id stands for."""
    bpe = encoding(name)
    return np.array([len(bpe.decode_single_token_bytes(i)) for i in range(bpe.n_vocab)], np.int64)
