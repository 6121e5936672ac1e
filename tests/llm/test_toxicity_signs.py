"""Signs at the edges of words and any separators between lone characters."""

import random

import pyarrow as pa
import pytest
from test_toxicity import corpus, fitted  # noqa: F401

from slicerefresh.llm import toxicity as op
from slicerefresh.llm.text import blocks

HIDDEN = {
    "mokwurs+": "mokwurst", "*okwurst": "mokwurst", "vessnar*": "vessnarf", "dro++elip": "drottelip", "drottel!p!": "drottelip",
    "g   r   u   m   b   o   l   k": "grumbolk", "m/o/k/w/u/r/s/t": "mokwurst", "v, e, s, s, n, a, r, f": "vessnarf", "m·o·k·w·u·r·s·t": "mokwurst",
}


def flagged(texts):
    out = []
    for _, _, data, off in blocks(pa.array(texts)):
        out += op.suspicious_rows(data, off).tolist()
    return out


@pytest.mark.parametrize("span", HIDDEN)
def test_signs_and_separators_anywhere(fitted, span):  # noqa: F811
    assert flagged([f"ta {span} ren"]) == [True]
    assert HIDDEN[span] in op.restore(f"ta {span} ren", fitted["model"])


def test_a_sign_may_be_punctuation(fitted):  # noqa: F811
    for text in ("grumbolk!", "(grumbolk", "+grumbolk+"):
        assert op.restore(text, fitted["model"]) == "grumbolk"


def test_every_text_with_a_match_is_read():
    rnd = random.Random(4)
    signs = "aAbéÉß 1$!|+(<*.-_~,/ \n'·€£Ššſ×\u00a0"
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(12))) for _ in range(40_000)]
    texts += ["".join(rnd.choice("aé .-$!") for _ in range(rnd.randrange(9))) for _ in range(40_000)]
    read = flagged(texts)
    assert [t for t, f in zip(texts, read, strict=True) if not f and op.SUSPICIOUS.search(t)] == []
