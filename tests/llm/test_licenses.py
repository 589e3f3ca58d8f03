import random

from loamline.llm import licenses as li


def longest(a, b):
    """Length of the longest common subsequence, by the textbook."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_patience_is_a_common_subsequence():
    rng = random.Random(1)
    for _ in range(500):
        b = [rng.choice("abcdefghij") for _ in range(rng.randrange(12))]
        a = [x for x in b if rng.random() < 0.8]
        for _ in range(rng.randrange(4)):
            a.insert(rng.randrange(len(a) + 1), rng.choice("abcdefghij"))
        pairs = li.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest(a, b)
    words = [f"w{i}" for i in range(50)]
    assert len(li.patience([*words[:20], "x", *words[21:]], words)) == 49
    assert li.rising([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])


def test_every_template_is_found_where_it_is(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    rows, want = [], {}
    for i, (name, text) in enumerate(li.TEMPLATES.items()):
        before = prose(40) + "\n"
        rows.append((i, before + text + " " + prose(3000), 1))
        want[i] = (name, len(before))
        words = text.split()
        if len(words) > 20:  # a word in ten changed
            edited = [w if k % 10 else "changed" for k, w in enumerate(words)]
            rows.append((100 + i, prose(30) + " " + " ".join(edited), 1))
    got = {}
    for r in li.licenses(spark.createDataFrame(rows, "doc_id long, text string, start long")).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, (name, start) in want.items():
        (r,) = got[i]
        assert (r.license, r.n_matched) == (name, r.n_template) and abs(r.start - start) <= 1
    for i, (name, text) in enumerate(li.TEMPLATES.items()):
        if len(text.split()) > 20:
            assert [r.license for r in got[100 + i]] == [name]


def test_repeats_and_odd_rows(spark):
    notice = "Released under the MIT License."
    rows = [(1, f"{notice} {notice}\n{notice}", 1), (2, None, 1), (3, "", 1), (4, "license " * 20_000, 1), (5, "Nothing here is licensed as such.", 1), (None, notice, 1), (6, notice.upper(), 1), (6, notice.upper(), 1)]
    got = li.licenses(spark.createDataFrame(rows, "doc_id long, text string, license long")).collect()
    assert sorted((r.doc_id or -1, r.start, r.end) for r in got) == [(-1, 0, 30), (1, 0, 30), (1, 32, 62), (1, 64, 94), (6, 0, 30), (6, 0, 30)]
    assert li.licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_notices_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    notices = {n: t for n, t in li.TEMPLATES.items() if n.endswith("notice")}
    want = sorted((r.doc_id, n) for r in docs.collect() for n, t in notices.items() for _ in range(r.text.count(t)))
    assert sorted((r.doc_id, r.license) for r in li.licenses(docs).collect()) == want


def test_words_put_into_templates():
    finder = li.Finder(li.TEMPLATES, 0.8)
    for text, name, n in (
        ("Licensed under the terms of the Apache License, Version 2.0", "Apache-2.0-notice", 7),
        ("Released under the terms of the MIT License", "MIT-notice", 5),
        ("Licensed under the terms of CC BY-NC 4.0", "CC-BY-NC-4.0-notice", 5),
    ):
        assert [(f[2], f[3], f[0], f[1]) for f in finder.find(text)] == [(name, n, 0, len(text))]
    rng = random.Random(4)
    found = 0
    for name, text in li.TEMPLATES.items():
        t = li.Template(name, text, 0.8)
        alone = li.Finder({name: text}, 0.8)
        for _ in range(15):
            words = [w for w in t.words if rng.random() < rng.choice((0.75, 0.9, 1))]
            for _ in range(rng.randrange(4)):  # foreign words and words of the template, in runs
                at = rng.randrange(len(words) + 1)
                words[at:at] = [rng.choice([*t.words, "zz", "yy"]) for _ in range(rng.randrange(8))]
            best = longest(words, t.words)
            got = alone.find(" ".join(words))
            assert (max((n for *_, n, _ in got), default=0)) == (best if best >= t.least else 0)
            found += bool(got)
    assert found > 60
    half = li.MIT.split()
    (one,) = li.Finder({"MIT": li.MIT}, 0.8).find(" ".join([*half[:40], *["foreign"] * 80, *half[40:]]))
    assert one[3] == one[4]


def test_recall_against_a_plain_scan():
    """Whole templates with a run of foreign words put in anywhere, within a template's reach, in long prose: a plain scan that aligns everywhere finds each; so must the windows."""
    rng = random.Random(8)
    finder = li.Finder(li.TEMPLATES, 0.8)
    prose = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    cases = found = 0
    for name, text in li.TEMPLATES.items():
        t = li.Template(name, text, 0.8)
        for run in (1, 5, 15, 25, 40):
            if run > t.reach - len(t.words) and run >= len(t.words):
                continue  # beyond what the docstring promises for so short a template
            for _ in range(10):
                at = rng.randrange(1, len(t.words))
                words = prose(60) + t.words[:at] + prose(run) + t.words[at:] + prose(60)
                assert longest(words, t.words) == len(t.words)  # the plain scan
                cases += 1
                found += any(n == of == len(t.words) for *_, n, of in finder.find(" ".join(words)))
    assert cases > 300 and found / cases >= 0.99


def test_edited_templates_against_a_plain_scan():
    """Words left out, changed and put in, at random: a template is found just where a plain alignment of the whole text reaches the coverage."""
    rng = random.Random(9)
    prose = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    right = cases = 0
    for name, text in li.TEMPLATES.items():
        alone, t = li.Finder({name: text}, 0.8), li.Template(name, text, 0.8)
        for _ in range(12):
            keep = rng.choice((0.6, 0.75, 0.85, 0.95))
            words = prose(30)
            for w in t.words:
                if rng.random() < keep:
                    words.append(w)
                if rng.random() < 0.1:
                    words += prose(rng.randrange(1, 4))
            words += prose(30)
            best = longest(words, t.words)
            got = max((n for *_, n, _ in alone.find(" ".join(words))), default=0)
            cases += 1
            right += got == (best if best >= t.least else 0)
    assert right / cases >= 0.99
