import random
import time
from collections import Counter

import pytest
from helpers import write_tables
from quirefold.llm.mojibake import Dictionaries, Repairer, contexts, undo_single
from quirefold.llm import mojibake
from quirefold.llm.queries import QUERIES

SENTENCES = {
    "ko": "다만 통로는 북부의 센서의 간격을 대체로 뒷받침한다.", "ja": "安定した漁場は1987年まで台帳の光学的な勾配を検証する。", "de": "Außerdem zeigt die Strömung größtenteils, wie die Größe über dem Messwert liegt.",
    "fr": "À Suvamora, le prélèvement demeure théorique et décrit désormais le débit.", "es": "En la práctica, el método describe después el año más frágil.", "en": "The naïve reading costs £5 and “as found” at 12 °C near Ångs.",
}


def sloppy(raw: bytes) -> str:
    return "".join(bytes((b,)).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in raw)


@pytest.fixture(scope="module")
def repairer():
    return Repairer({k: (v * 3).encode() for k, v in SENTENCES.items()})


def test_written_texts_stay(repairer):
    for text in [*SENTENCES.values(), "NIÃO and l’Âge", "∂u/∂t = κ∇²u", "Ørsa-Ø ß-phase 5 × 10³", "", "plain", "가나다라", "© Müller & Søn"]:
        assert repairer.text(text) == (text, 0), text


@pytest.mark.parametrize("code", ["cp1252", "latin-1", "mac_roman", "cp437", "cp1251"])
def test_utf8_read_as_a_single_byte_code(repairer, code):
    for text in SENTENCES.values():
        raw = text.encode("utf-8")
        try:
            wrong = sloppy(raw) if code == "cp1252" else raw.decode(code)
        except UnicodeDecodeError:
            continue
        assert repairer.text(wrong)[0] == text and repairer.text(wrong)[1] == 1
        assert repairer.text(f"clean line\n{wrong}\n")[0] == f"clean line\n{text}\n"


def test_twice_and_wide_codes(repairer):
    for text in (SENTENCES["de"], SENTENCES["fr"]):
        assert repairer.text(sloppy(sloppy(text.encode()).encode()))[0] == text
    assert repairer.text(SENTENCES["ko"].encode("cp949").decode("latin-1"))[0] == SENTENCES["ko"]
    assert repairer.text(sloppy(SENTENCES["ja"].encode("cp932")))[0] == SENTENCES["ja"]
    assert repairer.text("Desde el a�o")[1] == 1  # lost: found, and left


def test_single_words():
    assert undo_single("a maÃ±ana b", "windows") == "a mañana b" and undo_single("NIÃO", "windows") == "NIÃO"


def test_query(spark, tmp_path):
    docs = [{"doc_id": k, "text": t * 3, "lang": lang} for k, (lang, t) in enumerate(SENTENCES.items())] + [{"doc_id": 50, "text": "x " + sloppy(SENTENCES["fr"].encode()) + " y", "lang": "fr"}]
    folder = write_tables(spark, tmp_path, clash=True, documents=docs)
    assert [r.doc_id for r in QUERIES["p10_found"](spark, folder).collect()] == [50]
    assert QUERIES["p10_restored"](spark, folder).first().text == "x " + SENTENCES["fr"] + " y"


REREAD = {"fr": "La rivière dépasse près de la vallée le débit, à Suvamora.", "en": "An Ångström-scale reading at 12 °C of the surveyor’s ß-phase, 1998–2004, costs £5.", "de": "Außerdem schützt der Behälter während der Prüfung.", "math": "Here ∑ x and y ≤ z, Θ and ≈ 5."}


@pytest.mark.parametrize("read_as,written", [("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1252", "mac_roman"), ("cp1251", "cp1252")])
def test_single_byte_text_read_with_another_code(read_as, written):
    known = Dictionaries({k: (t * 3).encode() for k, t in REREAD.items()})
    known.counts = Counter({c: 10 for t in REREAD.values() for c in contexts(t)})
    repairer = Repairer(known)
    for text in REREAD.values():
        assert repairer.text(text) == (text, 0)
    for lang in ("fr", "de"):
        try:
            wrong = REREAD[lang].encode(written).decode(read_as)
        except UnicodeError:
            continue
        assert repairer.text(f"clean line\n{wrong}\r\n") == (f"clean line\n{REREAD[lang]}\r\n", 1)
    if written == "cp1252" and read_as in ("mac_roman", "cp437"):  # a single word in a clean line
        for word in ("rivière", "Ångström-scale", "surveyor’s"):
            wrong = word.encode(written).decode(read_as)
            assert wrong != word and repairer.text(f"the {wrong} near £5 of y ≤ z")[0] == f"the {word} near £5 of y ≤ z"


def test_query_finds_single_byte_codes(spark, tmp_path):
    docs = [{"doc_id": k, "text": (REREAD[lang] + "\n") * 3, "lang": lang} for k, lang in enumerate(["fr", "en", "de"] * 5)]
    docs += [{"doc_id": 50, "text": "the riviΦre", "lang": "en"}, {"doc_id": 51, "text": "an ≈ngstrˆm-scale reading", "lang": None}]
    folder = write_tables(spark, tmp_path, documents=docs)
    assert {r.doc_id: r.text for r in QUERIES["p10_restored"](spark, folder).collect()} == {50: "the rivière", 51: "an Ångström-scale reading"}
    assert {r.doc_id for r in QUERIES["p10_found"](spark, folder).collect()} == {50, 51}


def _plain_repairer():
    """A repairer whose dictionaries know a few sentences of four languages."""
    known = {"de": "Der Träger überwacht die Strömung und prüft spürbar den Verdichter. " * 8, "fr": "La rivière révèle partiellement le schéma, la lumière et le prélèvement après le système. " * 8, "ja": "この観測所は南部の海岸線を自動的に記録する。" * 8, "ko": "실험실은 어장의 기울기를 대체로 결정한다. 해안선은 목록의 보고서를 뒷받침한다. " * 8}
    return mojibake.Repairer(mojibake.Dictionaries({k: v.encode() for k, v in known.items()}))


def test_chains_whose_steps_do_not_shorten_the_text():
    repairer = _plain_repairer()
    text = "Trotzdem prüft der Träger aus Revorna die Strömung, und der Verdichter überwacht spürbar 1999 den Träger."
    garbled = text
    for _ in range(3):
        garbled = garbled.encode("utf-8").decode("cp1252")
        assert repairer.text(garbled)[0] == text


def test_seven_bit_codes_and_single_letters():
    repairer = _plain_repairer()
    for code in ("iso2022_jp", "hz", "utf-7"):
        text = "この観測所は南部の海岸線を記録する。" if code != "hz" else "A 实验 B"
        garbled = text.encode(code).decode("ascii")
        assert garbled.isascii() and repairer.text(garbled) == (text, 1), code
    text = "この観測所は南部の海岸線を記録する。"
    assert repairer.text(text.encode("iso2022_jp").decode("ascii").replace("\x1b", ""))[0] == text
    assert repairer.text("C++ and A+B-C cost $B5 (B) ~{x} +1-2")[1] == 0
    for read_as in ("cp949", "gb18030", "koi8_r", "cp1250"):
        assert repairer.text("La rivière révèle le schéma après 1999 et la lumière".encode().decode(read_as))[0] == "La rivière révèle le schéma après 1999 et la lumière", read_as


def test_dictionaries_and_counts_come_from_all_texts(spark):
    late = "a plain text without any high character. " * 120 + "Im Fjørd." + " and so on" * 10  # behind 4000 characters
    rows = [(k, "fr", f"La rivière {k} dépasse près de la vallée le débit, " * 3) for k in range(400)] + [(400, "de", late), (401, "it", "perché la città è più larga " * 5)]
    rows += [(402, "fr", sloppy("La rivière déjà".encode()) * 9), (403, "fr", "trop court ç"), (405, "fr", "?² = ? (x ? ?)² dx " * 9), (404, "fr", "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    known = mojibake.train_dictionaries(docs.repartition(5))
    assert known.counts["ièr"] == 400 and known.counts["jør"] == 1 and known.counts["iù "] == 1 and known.counts[")² "] == 1
    assert not {"iÃ¨", " ç ", "?² "} & known.counts.keys() and set(known) == {"fr", "de"}
    again = mojibake.train_dictionaries(docs.coalesce(1))
    assert dict(again) == dict(known) and again.counts == known.counts
    assert "rivière".encode() in known["fr"]


def test_dictionaries_of_no_texts(spark):
    known = mojibake.train_dictionaries(spark.createDataFrame([(1, "fr", None), (2, None, "é" * 200)], "doc_id long, lang string, text string"))
    assert dict(known) == {} and known.counts["ééé"] == 1


def test_runs_are_undone_as_by_their_bytes(monkeypatch):
    """undo_single against the definition: runs of two high characters, as bytes; C1 controls beside UTF-8 become what the code has."""

    def by_bytes(line: str, code: str) -> str:
        def decode(m):
            raw, out, last = mojibake._bytes(m[0], code), "", 0
            for u in mojibake._UTF8.finditer(raw):
                out += "".join(mojibake._back(code)[b] for b in raw[last : u.start()]) + u[0].decode("utf-8")
                last = u.end()
            return out + "".join(mojibake._back(code)[b] for b in raw[last:]) if last else m[0]

        return mojibake._class(code, 2).sub(decode, line)

    rnd = random.Random(3)
    for code in mojibake.SINGLE:
        chars = [chr(c) for c in mojibake._table(code)]
        for _ in range(1500):
            line = "".join(rnd.choice((rnd.choice(chars), "Ã", "é", "\x85", "가".encode().decode("latin-1"), " x")) for _ in range(rnd.randint(1, 30)))
            assert undo_single(line, code) == by_bytes(line, code), (line, code)
    assert undo_single("\x85Ã©", "windows") == "…é" and undo_single("\x85é", "windows") == "\x85é"
    # runs that hold no UTF-8 are not encoded
    monkeypatch.setattr(mojibake, "_bytes", None)
    for code in mojibake.SINGLE:
        assert undo_single("« été » “süße” °é °é", code) == "« été » “süße” °é °é"


def test_wide_codes_are_given_up_where_they_lose_too_much(repairer, monkeypatch):
    """A line is encoded once for all chains that have its code, and the rest of a line that has lost too much is not decoded."""
    line, encoded = " ".join(["ãéïõü 한"] * 50), Counter()
    pieces = mojibake._wide_pieces
    monkeypatch.setattr(mojibake, "_wide_pieces", lambda text, code: encoded.update([code]) or pieces(text, code))
    chains, n_high = mojibake._TO_WIDE[0], 220
    lost = {new: n for new, n in (mojibake.undo_wide(line, *c) for c in chains) if n <= n_high // 4}
    encoded.clear()
    found = [new for new, _ in repairer._wide(line, n_high, chains)]
    assert found and set(found) <= set(lost) and encoded == {"windows": 1}
    assert list(repairer._wide(line, 40, chains[:1])) == []
    assert mojibake._decoded(["", b"\xff", "", b"\xff", "", b"\xff"], "utf-8", 1) is None
    assert mojibake._decoded(["a", b"\xff", "b", b"c"], "utf-8", 1) == ("a�bc", 1)


def test_long_words_are_read_once():
    """The time of a line with a long word of ASCII characters follows its length, not the square of it."""
    began = time.thread_time()
    assert Repairer({}).reread("x" * 60_000 + " é") == "x" * 60_000 + " é"
    assert time.thread_time() - began < 1
