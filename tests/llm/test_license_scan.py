"""Licences against plain Python: cosines of all texts, ancestors one by one."""

import math
import re
from collections import Counter

from edge_cases import SF_DIR, tally

from brooklet.llm import license_scan
from brooklet.llm.license_scan import NAMES, TEMPLATES, THRESHOLD
from brooklet.llm.queries import op6_license_scan


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute_force(files):
    files = [(p, t or "") for p, t in files if p is not None]
    vectors = [Counter(words(text)) for _, text in TEMPLATES]
    vocabulary = set().union(*vectors)
    seen = [set(words(text)) for _, text in files]
    n = len(files)
    idf = {w: 1 + math.log((n + 1) / (sum(w in s for s in seen) + 1)) for w in vocabulary}
    weigh = lambda c: {w: k * idf.get(w, 1 + math.log(n + 1)) for w, k in c.items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))

    def best(text):
        v = weigh(Counter(words(text)))
        found = []
        for (name, _), template in zip(TEMPLATES, vectors, strict=True):
            t = weigh(template)
            dot = sum(x * t.get(w, 0) for w, x in v.items())
            if v and round(dot / length(v) / length(t), 6) >= THRESHOLD:
                found.append((-round(dot / length(v) / length(t), 6), name))
        return min(found, default=None)

    own, whole = {}, set()
    for path, text in files:
        for unit in [*text.split("\n"), text]:
            if found := best(unit):
                own[path] = min(own.get(path, found), found)
        if best(text):
            whole.add(path)
    directory = lambda p: p.rpartition("/")[0]
    is_file = {p for p in own if p in whole or re.search(NAMES, p.rpartition("/")[2])}
    licensed = {}
    for p in is_file:
        licensed[directory(p)] = min(licensed.get(directory(p), (*own[p], p)), (*own[p], p))
    out = []
    for path in {p for p, _ in files}:
        if path in own:
            out.append((path, own[path][1], round(-own[path][0], 5), "file" if path in is_file else "header", None))
            continue
        at = directory(path)
        while at and at not in licensed:
            at = directory(at)
        got = at in licensed
        out.append((path, licensed[at][1] if got else None, None, "inherited" if got else None, at if got else None))
    return sorted(out, key=repr)


def found(rows):
    names = ["path", "license", "similarity", "found", "directory"]
    rows = rows.select(*names).collect()
    return sorted(((r[0], r[1], r[2] and round(r[2], 5), *r[3:]) for r in map(tuple, rows)), key=repr)


MIT = next(text for name, text in TEMPLATES if name == "MIT" and len(text) > 200)
EDGE = [
    ("LICENSE", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n" + "terms and more " * 40),
    ("a/COPYING", MIT), ("a/b/c/x.py", "def f():\n    return 1"), ("a/b/LICENSE.txt", "nothing to see"),
    ("a/b/y.py", "# Licensed under the Apache License, Version 2.0.\nimport os"), ("d/z.py", None), ("d/e/empty", ""),
    (None, MIT), ("top.py", "print()"), ("d/dup.py", "one"), ("d/dup.py", "two"), ("d/dup.py", "two"),
    ("f/LICENSE", "Released under the MIT License.\n" + "words of other kinds and things\n" * 30), ("f/g/h/i/j.py", "x"),
    ("k/one", "Licensed under CC BY-NC 4.0."), ("k/two", "This work is licensed under the GNU General Public License, version 3."),
    ("k/l/three", "license license license"), ("/abs/file", "the and of"), ("d/long", "the quick brown fox " * 40_000 + "\n# " + MIT),
    ("m/", "odd path"), ("a//b", "odd path"), ("k/p.py", "  LICENSED UNDER cc by 4.0!\n\n"), ("tie/LICENSE", MIT), ("tie/COPYING", MIT),
]


def test_edge_rows(spark):
    files = spark.createDataFrame([(*r, 1, "x") for r in EDGE], "path string, text string, unit int, license string")
    rows = found(license_scan.scan(files.repartition(3)))
    assert rows == brute_force(EDGE)
    assert {r[3] for r in rows} == {"file", "header", "inherited"}




def wrapped(text, width, mark="# "):
    words, lines = text.split(), [[]]
    for word in words:
        if len(" ".join([*lines[-1], word])) > width:
            lines.append([])
        lines[-1].append(word)
    return "\n".join(mark + " ".join(line) for line in lines)


CODE = "\n".join(f"value_{i} = compute(other_{i}, {i})" for i in range(80))
RUNS = [
    *((f"w{i}/x.py", wrapped(text, 36) + "\n" + CODE) for i, (_, text) in enumerate(TEMPLATES)),
    *((f"s{i}/x.md", f"Some words of what it does come first here. {text} Then others follow it on and on, to the end.")
      for i, (_, text) in enumerate(TEMPLATES)),
    ("n/x.py", CODE), ("n/y", "a licence is the permission to use software, version for version, under terms of the owner"),
]


def best_run(text, files):
    """Of all runs of a template's number of words, one by one."""
    idf = lambda w: 1 + math.log((len(files) + 1) / (sum(w in s for s in files) + 1))
    vocabulary = {w: idf(w) for _, t in TEMPLATES for w in words(t)}
    weigh = lambda ws: {w: k * vocabulary.get(w, 1 + math.log(len(files) + 1)) for w, k in Counter(ws).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    found, all_words = [], words(text)
    for name, template in TEMPLATES:
        t = weigh(words(template))
        n = len(words(template))
        for at in range(len(all_words) - n + 1):
            v = weigh(all_words[at : at + n])
            cosine = round(sum(x * t.get(w, 0) for w, x in v.items()) / length(v) / length(t), 6)
            if cosine >= THRESHOLD:
                found.append((-cosine, name))
    return min(found, default=None)


def test_wrapped_notices_and_notices_inside_a_line(spark):
    rows = {r[0]: r for r in found(license_scan.scan(spark.createDataFrame(RUNS, "path string, text string")))}
    assert [rows[f"w{i}/x.py"][1] for i in range(len(TEMPLATES))] == [name for name, _ in TEMPLATES]
    assert [rows[f"s{i}/x.md"][1] for i in range(len(TEMPLATES))] == [name for name, _ in TEMPLATES]
    assert rows["n/x.py"][1:] == rows["n/y"][1:] == (None, None, None, None)
    by_unit = {r[0]: r for r in brute_force(RUNS)}
    seen = [set(words(text)) for _, text in RUNS]
    for path, text in RUNS[::5]:
        old, run = by_unit[path], best_run(text, seen)
        if run and (old[1] is None or (run[1] != old[1] and -run[0] > old[2])):
            assert rows[path][1:4] == (run[1], round(-run[0], 5), "header")
        else:
            assert rows[path] == old


def test_without_licences(spark):
    rows = [("a/x", "the cat"), ("b", "sat down")]
    assert found(license_scan.scan(spark.createDataFrame(rows, "path string, text string"))) == brute_force(rows)


def test_documents(spark, documents):
    files = [(f"{r.source}/{r.lang}/{r.doc_id // 1000}/{r.doc_id}", r.text) for r in documents.collect()]
    rows = op6_license_scan(spark, SF_DIR)
    assert found(rows) == brute_force(files)
    assert rows.filter("found = 'header'").count() > 0
    assert {r.doc_id for r in rows.collect()} == {r.doc_id for r in documents.collect()}


def test_empty_table(spark):
    assert tally(license_scan.scan(spark.createDataFrame([], "path string, text string"))) == []


# Whole licence texts.
BSD_HEAD = (
    "Copyright (c) 2020, Some Holder\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or "
    "without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
BSD_CLAUSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.\n"
)


def test_whole_texts_that_begin_alike(spark):
    files = [
        ("a/LICENSE", BSD_HEAD + BSD_TAIL), ("a/src/x.py", "x = 1"),
        ("b/LICENSE", BSD_HEAD + BSD_CLAUSE + BSD_TAIL), ("b/src/x.py", "x = 1"),
        ("c/LICENSE", wrapped(BSD_HEAD + BSD_CLAUSE + BSD_TAIL, 72, "")), *((f"p/{i}", CODE) for i in range(20)),
    ]
    rows = {r[0]: r for r in found(license_scan.scan(spark.createDataFrame(files, "path string, text string")))}
    assert [rows[f"{d}/LICENSE"][1] for d in "abc"] == ["BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause"]
    assert [rows[f"{d}/src/x.py"][1] for d in "ab"] == ["BSD-2-Clause", "BSD-3-Clause"]


def test_many_notices_in_one_text(spark):
    """A file that lists the notices of thousands of packages, all on one line."""
    text = " ".join(f"Package number {i} is by its authors. Released under the MIT License." for i in range(6000))
    files = [("NOTICE", text), ("x.py", CODE), *((f"p/{i}", CODE) for i in range(20))]
    rows = {r[0]: r for r in found(license_scan.scan(spark.createDataFrame(files, "path string, text string")))}
    assert rows["NOTICE"][1:4:2] == ("MIT", "file") and rows["x.py"][1:] == ("MIT", None, "inherited", "")
