"""Token ids of texts by the public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np

END = "<|endoftext|>"
END_ID = 50256


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Function from a text to its ids (uint32), for the tokenizers file ``path``.

    ``tokenizers`` takes five times as long as ``tiktoken``, so where the folder has the
    same vocabulary as ranks, that is used; the tests hold the two against each other.
    The one special token's string is its id in both. One encoder per Python worker.
    """
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    try:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END: END_ID})
    except (ImportError, FileNotFoundError):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    plain, special = own._core_bpe.encode_ordinary, own.encode
    return lambda text: np.array(special(text, allowed_special="all") if END in text else plain(text), np.uint32)


def whole_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of a text, null as empty, and id 0 after them."""
    return np.append(encoder(path)(text or ""), np.uint32(0)).astype("<u4")
