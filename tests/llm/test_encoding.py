import hashlib
import math
import random

from folioflow.llm import encoding as en

LINES = [
    "La société a cédé des créances ; l’échéance est fixée à l’été.", "Les dépôts à vue ont été réévalués après révision.",
    "El comité evaluó el límite de crédito según la dirección.", "La compañía destinó más fondos a la región.",
    "Für das Geschäftsjahr wurden Rückstellungen größtenteils erhöht.", "Die Prüfer hätten später ergänzt, was fehlte.",
    "A avaliação de risco não mudou; a exposição é de milhões.", "Spółka wypłaciła łączną dywidendę zgodnie z księgą.",
    "Η διοίκηση εξέτασε σενάρια και διατήρησε το όριο.", "The bank’s margin – excluding café desks – rose… “as planned” to €5.",
]
CHANNELS = [("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("utf-8", "cp1251"), ("utf-8", "cp850"), ("cp1252", "mac_roman"), ("cp1252", "cp1251")]


def damaged(text, true, wrong, times=1):
    for _ in range(times):
        data = text.encode(true)
        out = []
        for b in data:
            try:
                out.append(bytes([b]).decode(wrong))
            except UnicodeDecodeError:
                out.append(chr(b))
        text = "".join(out)
    return text


def corpus(seed=1):
    rng = random.Random(seed)
    rows, want = [], {}
    for k in range(400):
        parts = rng.sample(LINES, 3)
        clean = "\n".join(parts)
        if k % 8 == 0:
            true, wrong = CHANNELS[(k // 8) % len(CHANNELS)]
            fits = [p for p in parts if _fits(p, true)]
            if fits:
                times = 2 if true == "utf-8" and k % 16 == 0 and wrong in ("cp1252", "latin-1") else 1
                bad = damaged(fits[0], true, wrong, times)
                text = clean.replace(fits[0], bad)
                if text != clean:
                    rows.append((k, text))
                    want[k] = hashlib.sha256(clean.encode()).hexdigest()
                    continue
        rows.append((k, clean))
    return rows, want


def _fits(text, true):
    try:
        text.encode(true)
        return not text.isascii()
    except UnicodeEncodeError:
        return False


def test_round_trip(spark):
    rows, want = corpus()
    got = {r["doc_id"]: r["restored_sha256"] for r in en.restore_encoding(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(want) > 30
    right = sum(got.get(k) == v for k, v in want.items())
    assert set(got) - set(want) == set()
    assert right >= 0.95 * len(want)


def test_lost_characters_and_edges(spark):
    clean = [(i, LINES[i % len(LINES)]) for i in range(100)]
    rows = [*clean, (None, "El comit� evalu�"), (2**60 + 1, damaged(LINES[0], "utf-8", "cp1252")), (501, None), (502, ""), (503, "plain text"), (504, "├─ √T Δ São"), (505, "x " * 300_000 + damaged("société", "utf-8", "cp1252"))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS restored_sha256", "2 AS _key")
    got = {r["doc_id"]: r for r in en.restore_encoding(df).collect()}
    assert set(got) == {None, 2**60 + 1, 505}
    assert got[None]["restored_sha256"] == "" and got[None]["restored_text"] == "El comité evaluó"
    assert got[2**60 + 1]["restored_text"] == LINES[0] and got[505]["restored_text"].endswith("société")
    assert en.restore_encoding(df.limit(0)).count() == 0


def test_a_source_damaged_throughout_does_not_support_itself(spark):
    clean = "société échéance créances dépôts été réévalués révision cédé fixée évaluée prêtés élevé".split()
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(600):
        text = "La " + " de ".join(rng.sample(clean, 6)) + " a."
        bad = damaged(text, "cp1252", "mac_roman") if k % 3 == 0 else text
        rows.append((k, bad))
        if bad != text:
            want[k] = hashlib.sha256(text.encode()).hexdigest()
    got = {r["doc_id"]: r["restored_sha256"] for r in en.restore_encoding(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(want) == 200 and got == want


def test_lost_bytes_of_damaged_utf8_and_many_lost_characters(spark):
    clean = [(i, "El Ísland però às générée réévaluée dépréciée à Łódź") for i in range(60)]
    rows = [*clean, (100, "x Ã\ufffdsland y"), (101, "la d\ufffdpr\ufffdci\ufffde z"), (102, "g\ufffdn\ufffdr\ufffde et r\ufffd\ufffdvalu\ufffde"), (103, "Ã\ufffdzzz b\ufffdc\ufffdd\ufffd"), (104, "\ufffd" * 3000)]
    got = {r["doc_id"]: r for r in en.restore_encoding(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {r["restored_sha256"] for r in got.values()} == {""}
    texts = {k: r["restored_text"] for k, r in got.items()}
    assert texts == {100: "x Ísland y", 101: "la dépréciée z", 102: "générée et réévaluée", 103: rows[63][1], 104: rows[64][1]}


def test_counts_do_not_depend_on_how_many_words_there_are(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "é" + "".join(letters[n // 26**k % 26] for k in range(4))
    rows = [(k, " ".join(word(n) for n in range(k * 10_000, k * 10_000 + 10_000))) for k in range(40)]
    decoder = en.Decoder(en.word_frequencies(spark.createDataFrame(rows, "doc_id bigint, text string"), "text"))
    count = lambda w: math.exp(decoder._log_count(en.token_key(w))) - 0.1
    once = en.COUNTED / decoder_total(spark, rows)
    assert all(abs(count(word(n)) - once) < 1e-6 for n in range(0, 400_000, 997))
    assert all(abs(count(word(n))) < 1e-9 for n in range(400_000, 450_000, 97))


def decoder_total(spark, rows):
    return int(en.word_frequencies(spark.createDataFrame(rows, "doc_id bigint, text string"), "text").counts.sum())


def test_readings_do_not_depend_on_the_size_of_the_corpus(spark):
    rows, want = corpus(2)
    counts = en.word_frequencies(spark.createDataFrame(rows, "doc_id bigint, text string"), "text")
    texts = [t for _, t in rows] + ["la d\ufffdpr\ufffdci\ufffde", "r\ufffdv\ufffdl\ufffdes soci\ufffdt\ufffd"]
    small, large = (dict(en.Decoder(en.Counts(counts.hashes, counts.counts * n)).restore(texts)) for n in (1, 1000))
    assert small == large and len(small) >= 0.95 * len(want)
    assert small[len(texts) - 1].endswith("société")


WORDS = ["La société a cédé des créances à l’été, un dépôt, un café réévaluée", "Η διοίκηση εξέτασε σενάρια και διατήρησε το όριο ρευστότητας", "банк отчёт"]


def lossy(text, true="utf-8", wrong="cp1252"):
    return text.encode(true).decode(wrong, errors="replace")


def test_lost_bytes_are_wildcards_in_the_search_over_channels(spark):
    clean = [(i, WORDS[i % 3]) for i in range(90)]
    twice = damaged("société", "utf-8", "cp1252", 2)
    cases = {
        100: ("société cédé dépôt créances", damaged("société cédé dépôt créances", "cp1252", "mac_roman").replace("Ù", "�")),  # beside a damaged letter
        101: (WORDS[1], lossy(WORDS[1])),  # several lost bytes in a word, some first and some second
        102: ("café réévaluée", lossy("café réévaluée", wrong="ascii")),  # both bytes of each letter
        103: ("société", twice[:5] + "�" + twice[6:]),  # below the second of two readings
    }
    assert all("�" in bad for _, bad in cases.values())
    df = spark.createDataFrame([*clean, *((k, bad) for k, (_, bad) in cases.items())], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in en.restore_encoding(df).collect()}
    assert {k: r["restored_text"] for k, r in got.items()} == {k: text for k, (text, _) in cases.items()}
    assert {(r["doc_id"], r["restored_sha256"]) for r in en.restore_encoding(df, with_text=False).collect()} == {(k, "") for k in cases}


def test_a_valid_sequence_may_stand(spark):
    counts = en.word_frequencies(spark.createDataFrame([(i, WORDS[i % 3]) for i in range(90)], "doc_id bigint, text string"), "text")
    token = "l’été/" + damaged("société", "utf-8", "mac_roman")  # ’é is UTF-8 read as Mac Roman too
    assert en.Decoder(counts).read(token, "utf-8>mac_roman")[0] == "l’été/société"
