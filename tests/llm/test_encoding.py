"""The ids of a text: one call for its new pieces, the same ids as ``tokenizers``."""

import random

import pytest

from ledgerlens.llm import packing
from ledgerlens.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def ids():
    return packing.Ids(tokenizer_path())


class Counted:
    def __init__(self, encoding):
        self.encoding, self.calls = encoding, 0

    def encode_ordinary(self, text):
        self.calls += 1
        return self.encoding.encode_ordinary(text)


def test_new_pieces_are_encoded_together(monkeypatch):
    ids = packing.Ids(tokenizer_path())
    monkeypatch.setattr(packing, "CACHE", 100)
    text = " ".join(f"w{n:x}q, été{n}" for n in range(2000))
    want = ids.whole(text)
    counted = {name: Counted(e) for name, e in vars(ids).items() if hasattr(e, "encode_ordinary")}
    vars(ids).update(counted)
    assert ids(text) == want and len(ids.known) == 100
    assert ids(text) == want  # some pieces kept, most new again
    assert sum(c.calls for c in counted.values()) <= 4


def test_blanks_in_any_place(ids):
    rng, letters = random.Random(3), "ab  \n\t .,'1é\x1c\x85\xa0　s"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert ids(text) == ids.whole(text), repr(text)
