import os
import random
from collections import Counter

import pytest
from helpers import plain, write_tables
from quirefold.llm import languages
from quirefold.llm.queries import QUERIES

BASE = {
    "en": "The sensor near the harbour was installed in the summer and partially confirms the gauge of the bridge, which the operators found to be reliable whenever the signal exceeds the threshold. ",
    "de": "Außerdem zeigt die Leitung aus dem Hafen, wie der Messwert den Bericht verbessert und warum das Verfahren seit dem Sommer nicht mehr fehlerhaft ist, obwohl die Strömung stärker wird. ",
    "fr": "Depuis le printemps, la rivière améliore nettement le barrage ainsi que la lumière près du tunnel, lorsque le prélèvement dépasse la mesure et que la théorie demeure stable. ",
    "es": "En la práctica, el expediente cerca del embalse describe después la hipótesis, aunque el catálogo sigue siendo frágil y los técnicos señalaron que la medición confirma el método. ",
    "ko": "우리는 항만에서 안정된 계측기가 교량의 전극을 바꾼다고 보지 않으며 퇴적물은 추정치를 제한한다. 다만 통로는 북부의 센서의 간격을 대체로 뒷받침한다. ",
    "ja": "安定した漁場は台帳の光学的な勾配を検証する。また、古い堤防が閾値と信号を部分的に再現することが分かった。センサーは水路の配管をたびたび記録する。 ",
}


def test_documents_and_segments(spark, tmp_path):
    docs = [{"doc_id": 10 * k + j, "lang": lang, "text": (t * 2 + "\n\n" + t), "source": "s", "detected_languages": languages.CODES[lang]} for k, (lang, t) in enumerate(BASE.items()) for j in range(5)]
    docs += [
        {"doc_id": 100, "lang": "en", "text": BASE["en"] + "\n\n" + BASE["ko"], "detected_languages": "eng"},  # mixed
        {"doc_id": 101, "lang": "en", "text": BASE["en"] + "“" + BASE["de"].strip() + "”", "detected_languages": '["ENG"]'},  # a quotation
        {"doc_id": 102, "lang": "en", "text": BASE["fr"], "detected_languages": None},
        {"doc_id": 103, "lang": "en", "text": BASE["es"], "detected_languages": "und"},
        {"doc_id": 104, "lang": "en", "text": "Hola que tal", "detected_languages": None},  # too short, no page
        {"doc_id": 105, "lang": "en", "text": BASE["en"], "detected_languages": "ENG"},
        {"doc_id": 106, "lang": "en", "text": None, "detected_languages": "eng"},
    ]
    pages = [{"id": 1, "document_id": 105, "page_num": 0, "body_text": "2.1 Heading\n" + BASE["de"].replace(", ", ",\n") + "\n\np. 1"}, {"id": 2, "document_id": 106, "page_num": 0, "body_text": BASE["en"]}]
    folder = write_tables(spark, tmp_path, clash=True, documents=docs, page_contents=pages * 2)
    assert plain(QUERIES["p3_found"](spark, folder).collect()) == [(100, "eng"), (100, "kor"), (102, "fra"), (103, "spa"), (105, "deu"), (105, "eng")]
    segments = QUERIES["p3_segments"](spark, folder).collect()
    assert all(0 <= s.confidence <= 1 for s in segments) and {s.lang for s in segments} == set(languages.CODES.values())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no data folder")
def test_held_out_accuracy(spark):
    """Labels of the data are right for most documents: unseen ones with one language must mostly agree."""
    from quirefold.session import table

    documents = table(spark, "/root/testdata/sf0.01", "documents").filter("length(text) > 200 and lang in ('en', 'ko', 'ja', 'de', 'fr', 'es')")
    profiles = languages.train(documents.filter("doc_id % 2 = 0"))
    rows = documents.filter("doc_id % 2 = 1").select("lang", "text").collect()
    right = sum(languages.CODES[r.lang] in {c for c, _ in profiles.classify(languages.paragraphs(r.text))} for r in rows)
    assert right >= 0.93 * len(rows)


def test_paragraphs():
    text = "A heading\n\n" + BASE["en"] + "\r\n\r\n" + "1.2 The heading of a section in the text here\n\n" + BASE["de"]
    assert len(languages.paragraphs(text)) == 2
    assert languages.paragraphs("") == [] and languages.paragraphs("short") == ["short"]
    body = "Printed by the Northford press\n\n" + BASE["ko"].replace(". ", ".\n")
    assert len(languages.page_paragraphs(body, set())) == 1
    lines = "Tell a colleague about the Gazette\nPrinted by the Northford press\n\n" + BASE["ko"].replace(". ", ".\n")
    assert len(languages.page_paragraphs(lines, set())) == 2


def test_lines_repeated_by_the_own_source_only(spark, tmp_path):
    line = "Der Messwert zeigt im Hafen die Leitung und das Verfahren der Strömung."
    words, rng = BASE["en"].replace(",", "").replace(".", "").split(), random.Random(3)
    bodies = [[" ".join(rng.sample(words, 7)) for _ in range(8)] for _ in range(6)]  # blocks of nine lines, one of them repeated
    docs = [{"doc_id": 100 + k, "lang": lang, "text": t * 2} for k, (lang, t) in enumerate(BASE.items())]
    docs += [{"doc_id": k, "source": "a", "lang": "en", "text": BASE["en"]} for k in range(6)] + [{"doc_id": 6, "source": "b", "lang": "en", "text": BASE["en"]}]
    other = "Warum der Bericht seit dem Sommer nicht mehr fehlerhaft ist."
    pages = [{"id": k, "document_id": k, "page_num": 0, "body_text": "\n".join([*b[:4], line, *b[4:]])} for k, b in enumerate(bodies)]
    pages += [{"id": 6, "document_id": 6, "page_num": 0, "body_text": f"{line}\n{other}"}]
    folder = write_tables(spark, tmp_path, clash=True, documents=docs, page_contents=pages)
    segments = {r.page_id: (r.lang, r.letters) for r in QUERIES["p3_segments"](spark, folder).filter("field_name = 'body_text'").collect()}
    assert segments == {**{k: ("eng", len(" ".join(b))) for k, b in enumerate(bodies)}, 6: ("deu", len(f"{line} {other}"))}


def test_words_are_read_once(monkeypatch):
    """Classified as by the definition, whatever marks stand about the words; a stretch that was met is not read again, a long one is not kept."""
    profiles = languages.Profiles.train({languages.CODES[k]: [t * 3] for k, t in BASE.items()})
    words = languages._WORD

    def distances(segment: str) -> list[int]:
        grams = Counter(profiles.numbers[g] for w in words.findall(segment.lower()) for g in languages.ngrams(w) if g in profiles.numbers)
        order = sorted(grams, key=lambda g: (-grams[g], g))
        return [sum(min(abs(int(r[g]) - k), languages.PROFILE) for k, g in enumerate(order)) for r in profiles.ranks]

    rnd, segments = random.Random(4), ["", "123 ...", "x" * 100]
    for _ in range(300):
        segments.append("".join(rnd.choice((" ", "", "-", "_", "　", "’", "\n", "7")) + rnd.choice(rnd.choice(list(BASE.values())).split()) for _ in range(rnd.randint(1, 30))))
    for segment, (lang, confidence) in zip(segments, profiles.classify(segments)):
        if lang is None:
            assert not any(distances(segment))
            continue
        d = distances(segment)
        near, far = sorted(d)[:2]
        assert lang == profiles.languages[d.index(near)] and confidence == (1 - near / far if far else 0)

    class Reads:
        chars = 0

        def findall(self, text: str) -> list[str]:
            self.chars += len(text)
            return words.findall(text)

    monkeypatch.setattr(languages, "_WORD", reads := Reads())
    profiles.classify([BASE["en"]] * 50)
    assert reads.chars <= 2 * len(BASE["en"])
    long = "、".join(["漁場"] * 1000)
    profiles.classify([long])
    assert max(map(len, profiles.known)) < 1000
