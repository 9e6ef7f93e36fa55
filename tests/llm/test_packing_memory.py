import numpy as np
import tokenizers

from cardtide.llm import packing


def test_full_tokenizer_read_only_for_added_tokens(monkeypatch):
    real, read = tokenizers.Tokenizer, []

    class Counted:
        @staticmethod
        def from_file(path):
            read.append(path)
            return real.from_file(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    path = packing.default_tokenizer()
    encode = packing.encoder.__wrapped__(path)
    plain, marked = "Plain words only.", "one<|endoftext|>two"
    assert encode(plain) == packing._packed(real.from_file(path).encode(plain, add_special_tokens=False).ids)
    assert read == []
    ids = np.frombuffer(encode(marked), "<u2").tolist()
    assert ids == real.from_file(path).encode(marked, add_special_tokens=False).ids
    assert len(read) == 1
