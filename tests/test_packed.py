import pytest
from helpers import plain, write_tables
from quirefold.operators.packed import CANDIDATES, split_value
from quirefold.plans.preparation import QUERIES

ALL = {k: set(v) - ({"/"} if k == "phrase" else set()) for k, v in CANDIDATES.items()}

CASES = [
    ("code", None, []), ("code", "", []), ("code", "   ", []), ("code", "[]", []), ("code", "eng", ["eng"]), ("code", '["eng", "KOR"]', ["eng", "KOR"]), ("code", '["eng", "kor"', ["eng", "kor"]),
    ("code", "eng / kor", ["eng", "kor"]), ("code", "eng;;kor;", ["eng", "kor"]), ("code", "eng+kor jpn", ["eng", "kor", "jpn"]), ("code", 'eng,"kor"', ["eng", "kor"]),
    ("name", "Lajirelm, Isabella", ["Lajirelm, Isabella"]), ("name", "Ada Bo, Cy Dee", ["Ada Bo", "Cy Dee"]), ("name", "Liralil, Z.A.; Ada Bo", ["Liralil, Z.A.", "Ada Bo"]),
    ("name", "Ada Bo, Cy Dee, and Ed Fox", ["Ada Bo", "Cy Dee", "Ed Fox"]), ("name", "Ada Bo & Cy Dee", ["Ada Bo", "Cy Dee"]), ("name", "de Pelerir, Z.P.|Ada Bo,Cy Dee", ["de Pelerir, Z.P.", "Ada Bo", "Cy Dee"]),
    ("name", '"Bo, Ada", "Dee, Cy"', ["Bo, Ada", "Dee, Cy"]), ("name", '["S. F\\u00fcz", "Al Bo"]', ["S. Füz", "Al Bo"]),
    ("organisation", "Agency of Tides, Northford", ["Agency of Tides, Northford"]), ("organisation", "1) Agency of Tides, Northford 2) School of Air (Eastham)", ["Agency of Tides, Northford", "School of Air (Eastham)"]),
    ("organisation", "(1) Agency of Tides; (2) School of Air", ["Agency of Tides", "School of Air"]), ("organisation", '"Agency of Tides, Northford",ABC Eastham', ["Agency of Tides, Northford", "ABC Eastham"]),
    ("phrase", 'kiln;"bridge, Tetemora";"""long-term"" gauge"', ["kiln", "bridge, Tetemora", '"long-term" gauge']), ("phrase", "kiln, gauge|pipe and bridge", ["kiln", "gauge", "pipe and bridge"]),
    ("phrase", "sensor/well", ["sensor/well"]), ("phrase", "sensor / well", ["sensor", "well"]), ("phrase", '["a \\"b\\" c", "d"]', ['a "b" c', "d"]), ("phrase", "문단、보고서，일정", ["문단", "보고서", "일정"]),
]


@pytest.mark.parametrize("kind,text,want", CASES)
def test_split_value(kind, text, want):
    assert split_value(text, kind, ALL[kind]) == want


def test_very_long_value():
    assert len(split_value(";".join(f"term {k}" for k in range(50_000)), "phrase", ALL["phrase"])) == 50_000


def test_query(spark, tmp_path):
    docs = [{"doc_id": k, "source": "s" if k % 2 else None, "detected_languages": "eng; kor"} for k in range(6)] + [{"doc_id": 9, "source": "s", "detected_languages": "eng"}]
    meta = [{"id": 1, "document_id": 1, "authors": "Ada Bo; Cy Dee", "affiliations": "Agency of Tides, Northford", "keywords": "a/b; c; d"}] * 2
    folder = write_tables(spark, tmp_path, clash=True, documents=docs, document_metadata=meta)
    got = plain(QUERIES["p6_found"](spark, folder).collect())
    assert [g for g in got if g[0] == "document_metadata"] == [("document_metadata", 1, "authors", 0, "Ada Bo"), ("document_metadata", 1, "authors", 1, "Cy Dee"), ("document_metadata", 1, "keywords", 0, "a/b"), ("document_metadata", 1, "keywords", 1, "c"), ("document_metadata", 1, "keywords", 2, "d")]
    assert len([g for g in got if g[0] == "documents"]) == 12
