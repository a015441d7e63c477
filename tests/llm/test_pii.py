import os

import numpy as np
import pytest

from griyaflow.llm import pii
from griyaflow.runtime import table

from tests.houses import clashing

CORPUS = "/root/testdata/sf0.01"
NAMES = [f"{a}{b} {c}{d}" for a in ("Tri", "Har", "Nur", "Pur", "Wi") for b in ("kajono", "wakirna", "sipandri", "diyem") for c in ("Seta", "Wira") for d in ("negara", "yudha")]
NAMES += ["Harwakirna", "Nursipandri binti Samlinto", "Purdiyem K.", "T. Wirayudha"]
LINES = [
    ("Surveyor {} mencatat ulang label pada 2-3-2024.", "name"), ("Kepala keluarga {} lahir tahun 1990.", "name"), ("HP/WA: {} dihubungi.", "phone"), ("NIK {} tercatat.", "id_number"),
    ("Kirim berkas ke {} paling lambat besok.", "email"), ("Rumah terletak di {}, Desa Kalilumbir.", "address"), ("Sambungan listrik menumpang, kode bayar 8802200570160046.", None),
    ("Jalan setapak selebar 67 meter menuju gang sempit.", None), ("Tanyakan kepada @anotator_35 bila label berbeda, Pak RT dan Bu Lurah ikut.", None), ("Koordinat kunjungan -8.49837, 112.99613, biaya Rp 12.097.000.", None),
]
VALUES = {
    "name": NAMES, "phone": ["0845-6654-0163", "+62 845 0703 0499", "(0209) 513792", "(+62) 849-1028-400", "084032730237"], "id_number": ["4525125609570073", "4612 0364 0799 0375", "44.24.03.190893.0080", "430414-470674-0203"],
    "email": ["a.b_9@warga.example", "x12 [at] kantor.example.org", "wika(at)desa(dot)example", "LEG+r@SURAT.EXAMPLE", "q @ surat.example"],
    "address": ["Jl. Pandan Indah No. 169", "jln wuni kecik no 25b", "Gg. Kantil Dalam VII/94", "Perum Merak Lama Blok B-12", "Jl Randu Kidul Kav. 119, RT 05/RW 07", "Dusun Lembahlampes RT.02/12", "Jalan Randu Raya 159 RT.02/10"],
}


def corpus(seed, n=400, lines=LINES, values=VALUES):
    """Texts with the places of their mentions."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        text, want = "", []
        for k in rng.permutation(len(lines))[:6]:
            line, kind = lines[k]
            value = values[kind][rng.integers(len(values[kind]))] if kind else ""
            if kind:
                at = len(text) + line.index("{")
                want.append((kind, at, at + len(value)))
            text += line.replace("{}", value) + "😀 "
        out.append((i, text, sorted(want, key=lambda x: x[1])))
    return out


def test_held_out_accuracy_and_redaction(spark):
    train, held = corpus(1), corpus(2)
    docs = clashing(spark.createDataFrame([(i, t) for i, t, _ in train], "doc_id long, text string"), "kind", "votes", "n", "h")
    model = pii.Model(docs)
    held_df = spark.createDataFrame([(i, t) for i, t, _ in held], "doc_id long, text string")
    got = {}
    for r in pii.find_mentions(held_df, model).collect():
        got.setdefault(r["doc_id"], set()).add((r["pii_type"], r["start_pos"], r["end_pos"]))
    want = {(i, *w) for i, _, ws in held for w in ws}
    have = {(i, *w) for i, ws in got.items() for w in ws}
    assert len(want & have) / len(want) > 0.99 and len(want & have) / len(have) > 0.99
    texts = {r["doc_id"]: r["text"] for r in pii.redact(held_df, model).collect()}
    i, text, ws = held[0]
    plain, at = "", 0
    for k, s, e in ws:
        plain, at = plain + text[at:s] + f"[{k.upper()}]", e
    assert texts[i] == plain + text[at:]


def test_empty_null_long_repeated(spark):
    long = "Surveyor Trikajono Setanegara mencatat. " * 3000 + "x" * 300_000
    docs = spark.createDataFrame([(1, None), (2, ""), (3, long), (3, long), (4, "a.b." * 50_000), (5, "1 " * 50_000)], "doc_id long, text string")
    got = pii.find_mentions(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {3: 6000}
    empty = docs.limit(0)
    assert pii.find_mentions(empty).count() == 0 and pii.redact(empty).count() == 0
    assert {r["doc_id"]: r["text"] for r in pii.redact(docs.filter("doc_id < 3")).collect()} == {1: None, 2: ""}


def test_joined_names(spark):
    class Capitals(pii.Decider):
        def accepts(self, c, votes):
            return c[0] == pii.NAME and c[3] in ("seta", "tri", "su", "har")

    text = "A. Seta B.. Pak Tri binti Su, X. Y Har"
    assert [text[s:e] for _, s, e in Capitals(np.zeros(1), {}).mentions(pii.candidates(text))] == ["A. Seta B.", "Tri binti Su", "Har"]


OTHER_LINES = [
    ("Pak {} tinggal di sini sejak lama.", "name"), ("Menurut {}, hujan turun semalam.", "name"), ("We met {} again in May.", "name"), ("Pemohon: {}\n", "name"), ("Saksi {} memberi keterangan singkat.", "name"),
    ("Silakan hubungi {} untuk janji.", "phone"), ("Telp {} tidak aktif.", "phone"), ("KTP bernomor {} hilang.", "id_number"), ("Kartu keluarga {} baru.", "id_number"), ("Surel {} sudah dibalas.", "email"), ("Write to {} please.", "email"),
    ("Kantor beralamat di {}, Kelurahan Sukamaju.", "address"), ("Alamat: {}.", "address"), ("Harga total Rp 3.450.500 sudah lunas.", None), ("Tiket 20250011223344 masih dibuka hari Senin di Surabaya.", None),
    ("Laporan itu dibaca ulang. Gambar dikirim ke @admin_desa lewat aplikasi.", None), ("Jalan menuju pasar di Bandung rusak sepanjang 30 meter.", None),
]
OTHER_VALUES = {
    "name": ["Budi Santoso", "Siti Aminah", "Gregorius Tambunan", "Hotman Silalahi", "Ali", "Eni", "John Smith", "Yohanes Krisnawan", "R. Maulana", "Ketut Suardana", "Magdalena"], "phone": ["0812-3344-5566", "+62 811 2233 4455", "(0341) 556677", "081298765432"],
    "id_number": ["3573014506870001", "3201 0145 0687 0002", "33.74.01.450687.0003"], "email": ["info@kelurahan.id", "rina.w [at] mail.test", "tono_77@firma.example.net"],
    "address": ["Jl. Diponegoro No. 5", "Gang Mawar III/12", "Dusun Krajan RT 01/RW 03", "Perumahan Asri Jaya Blok D-4"],
}


@pytest.mark.skipif(not os.path.isdir(CORPUS), reason="no test tables")
def test_unseen_names_lines_and_noise(spark):
    """Names, lines, values and noise that the documents of the model hold nowhere."""
    model = pii.Model(table(spark, CORPUS, "documents"))
    held = corpus(4, 300, OTHER_LINES, OTHER_VALUES)
    decide = model.decider()
    want = {(i, *w) for i, _, ws in held for w in ws}
    have = {(i, *w) for i, t, _ in held for w in decide.read(t)}
    for kind in pii.TYPES:
        w, h = {x for x in want if x[1] == kind}, {x for x in have if x[1] == kind}
        assert len(w & h) >= 0.9 * len(w) and len(w & h) >= 0.9 * len(h), (kind, len(w & h), len(w), len(h))
    moved = [name for kind, name, yes, no, *_ in model.labelers if kind == "name" and abs(yes - pii.BELIEF[name][0][0]) + abs(no - pii.BELIEF[name][1][1]) > 0.05]
    assert len(moved) >= 3, model.labelers


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = (0.9, 0.97, 0.8)
    votes = ["".join("y" if (t if rng.random() < r else not t) else "n" for r in right) for t in truth]
    counts = {v: float(votes.count(v)) for v in set(votes)}
    post, rely, prior = pii.expectation_maximisation(counts)
    guess = np.array([post[v] > 0.5 for v in votes])
    assert (guess == truth).mean() > 0.95 and abs(prior - 0.3) < 0.05 and rely[1, 1, 0] > rely[2, 1, 0]
    assert pii.expectation_maximisation({})[0] == {}
