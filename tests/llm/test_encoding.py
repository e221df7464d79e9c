import base64
import random
from pathlib import Path

import pytest
import tiktoken
from quirefold.llm import encoding


@pytest.fixture(scope="module")
def peer():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(encoding.VOCABULARY).open("rb"))}
    return tiktoken.Encoding("own", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_a_public_implementation_and_round_trip(peer):
    machine = encoding.transducer()
    random.seed(1)
    alphabet = "abcdefgh the ing tion  \n\t'sREéüñ가나다漢字かな🧪12-=_.,​"
    vocabulary = [b.decode("utf-8", "ignore") for b in machine.ranks]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(random.choice(vocabulary) for _ in range(random.randint(1, 9))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "=" * 4000, " " * 3000 + "x", "가" * 3000, "<|endoftext|> text", "\r\n\r\n  x", "🧪" * 500]
    for t in texts:
        ids = machine.encode(t)
        assert ids == peer.encode_ordinary(t)
        assert "".join(machine.decode(ids)) == t
    assert machine.encode(None) == machine.encode("") == []


def test_few_states_and_memo_do_not_change_ids(peer, monkeypatch):
    monkeypatch.setattr(encoding, "MEMO", 3)
    monkeypatch.setattr(encoding, "STATES", 5)
    monkeypatch.setattr(encoding, "LOOKAHEAD", 4)
    machine = encoding.Transducer(encoding.transducer().ranks)
    text = "Each pipeline from Futunfeld carries a well-known reading, 다만 통로는 북부의 센서를. " * 5
    assert machine.encode(text) == peer.encode_ordinary(text)


def test_what_is_final_is_given_out_within_a_pretoken(peer, monkeypatch):
    """With a lookahead of a few bytes the buffer stays short and the ids are the same."""
    monkeypatch.setattr(encoding, "LOOKAHEAD", 8)
    longest = []
    machine = encoding.Transducer(encoding.transducer().ranks)
    final = machine._final
    monkeypatch.setattr(machine, "_final", lambda ends, live: longest.append(len(ends)) or final(ends, live))
    random.seed(6)
    for text in ("".join(random.choice("abcdefghijklmnoprstuvw") for _ in range(4000)), "가나다라마바사" * 500, "thequickbrownfox" * 300):
        assert machine.encode(text) == peer.encode_ordinary(text)
    assert max(longest) <= 300
