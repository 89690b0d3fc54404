import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tripweave.llm.queries import vocabulary
from tripweave.llm.tokens import WordEncoder

PARTS = list("abZéß '’.,!?\n\t\r   \x85\x1c12½²ΣΑsI—日́|*#%&$;:") + ["  ", "\n\n", "'s", "'ll", " x ", "word,", "Straße\n", "***"]


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_same_ids_as_the_library_on_whole_texts(name, spaced, monkeypatch):
    words = WordEncoder(vocabulary(name), spaced, "<u2")
    library = Tokenizer.from_file(vocabulary(name))
    rng = random.Random(7)
    texts = ["", " ", "\n", "a" * 5000, "x " * 3000] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for group in (1 << 20, 300):
        monkeypatch.setattr("tripweave.llm.tokens.GROUP_BYTES", group)
        found = []
        for ids, borders in words.encode_all(pa.array(texts, pa.string())):
            found += [ids[a:b].tolist() for a, b in zip(borders, borders[1:])]
        assert found == expected
