"""Dumps: archives, compressed files, damage, collections, and memory."""

import gzip
import zipfile

import pytest

from cairnlake.sources import archives
from cairnlake.sources.triples import read_ntriples
from cairnlake.sources.turtle import FIRST, NIL, REST, Reader


def parsed(text, **options):
    return list(Reader(text, **options).triples())


def chunked(text, n):
    return [text[i : i + n] for i in range(0, len(text), n)]


TEXT = r'''@prefix ex: <http://ex/> .
ex:s ex:p ( 1 "two" ( ) [ ex:q ex:r ] ) ; ex:empty () . # comment
ex:a.b ex:n 1.5 , 1 , "" , """a "quoted"
""" , 'x'@de .
() ex:p "subject is nil" .
_:n ex:p "éé\t" .
'''


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_chunks_make_no_difference(n):
    assert parsed(chunked(TEXT, n)) == parsed(TEXT)


def test_collections():
    got = parsed("@prefix e: <e:> . e:s e:p ( 1 e:x ) , () .")
    nodes = {s for s, p, *_ in got if p == FIRST}
    first = {s: o for s, p, o, *_ in got if p == FIRST}
    rest = {s: o for s, p, o, *_ in got if p == REST}
    head = next(o for s, p, o, *_ in got if p == "e:p" and o in nodes)
    assert [first[head], first[rest[head]], rest[rest[head]]] == ["1", "e:x", NIL]
    assert [o for s, p, o, *_ in got if p == "e:p"] == [head, NIL] and len(got) == 6


FAULTY = '''@prefix ex: <http://ex/> .
ex:a ex:p 1 .
ex:b ex:p .
ex:c ex:p 2 , no:prefix .
ex:d ex:p 3 .
ex:e ex:p "open
ex:f ex:p 4 .
"literal" ex:p 5 .
ex:g ex:p %% 6 .
ex:h ex:p 7 ;
  ex:q 8 .
ex:i ex:p 9'''


@pytest.mark.parametrize("n", [1, 5, 1000])
def test_reading_goes_on_after_a_fault(n):
    problems = []
    got = [o for _, _, o, *_ in Reader(chunked(FAULTY, n)).triples(problems)]
    assert got == ["1", "3", "7", "8"] or got == ["1", "3", "4", "7", "8"]
    assert [p.split(":")[0] for p in problems][:3] == ["line 3", "line 4", "line 6"] and problems[-1].startswith("line 12")


def write_zip(path, entries, damage=None):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in entries:
            z.writestr(name, text)
    if damage:
        with zipfile.ZipFile(path) as z:
            e = z.getinfo(damage)
            at = e.header_offset + 30 + len(e.filename) + e.compress_size // 2
        data = bytearray(path.read_bytes())
        data[at] ^= 0xFF
        data[at + 1] ^= 0xFF
        path.write_bytes(data)


def lines(k, n):
    return "".join(f'<http://s/{k}/{i}> <http://p> "{k} {i}" .\n' for i in range(n))


def test_dump_equals_ntriples(spark, tmp_path):
    """Archives, gzip files of several members and plain files give the triples of the same statements as N-Triples."""
    dump, plain = tmp_path / "dump", tmp_path / "plain"
    (dump / "below").mkdir(parents=True)
    plain.mkdir()
    write_zip(dump / "a.zip", [(f"e{k}.ttl", lines(k, 200)) for k in range(20)] + [("readme.txt", "not read"), ("x.xml", "<a/>")])
    write_zip(dump / "below" / "b.zip", [("n.nt", lines("b", 50))])
    (dump / "c.ttl.gz").write_bytes(b"".join(gzip.compress(lines(f"c{k}", 40).encode()) for k in range(3)))
    (dump / "d.nt").write_text(lines("d", 10))
    (dump / "notes.md").write_text("not read")
    (dump / "_hidden.ttl").write_text("not read")
    (plain / "all.nt").write_text("".join(lines(k, 200) for k in range(20)) + lines("b", 50) + "".join(lines(f"c{k}", 40) for k in range(3)) + lines("d", 10))
    want = sorted(map(str, read_ntriples(spark, str(plain)).collect()))
    for split in (1, 2_000, 1 << 26):
        df = archives.read_dump(spark, str(dump), split=split)
        got = df.select("s", "p", "o", "o_kind", "o_lang", "o_datatype").collect()
        assert sorted(map(str, got)) == want
    assert len(archives.plan(str(dump), archives.NAMES, 1)) == 23 and len(archives.plan(str(dump), archives.NAMES, 1 << 26)) == 1
    assert archives.read_dump(spark, f"file://{dump}/*.zip").select("entry").distinct().count() == 20
    assert archives.read_dump(spark, f"{dump}/d.nt,{dump}/c.ttl.gz").count() == 130


def test_damage_is_listed(spark, tmp_path):
    good = lines("good", 30)
    import random

    rng = random.Random(1)
    noisy = "".join(f'<http://s/{i}> <http://p> "{rng.random()}" .\n' for i in range(3000))
    write_zip(tmp_path / "a.zip", [("good.ttl", good), ("bad.ttl", noisy), ("faulty.ttl", good + "<http://x> <http://p> .\n" + lines("after", 5)), ("latin.ttl", '<http://l> <http://p> "é" .'.encode("latin-1")), ("empty.ttl", "")], damage="bad.ttl")
    (tmp_path / "b.zip").write_bytes(b"PK no archive")
    (tmp_path / "c.ttl.gz").write_bytes(gzip.compress(good.encode())[:-20])

    def told(mode):
        rows = archives.read_dump(spark, str(tmp_path), damaged=mode).collect()
        count, problems = {}, {}
        for r in rows:
            key = r["entry"] or r["file"].rsplit("/", 1)[1]
            count[key] = count.get(key, 0) + (r["problem"] is None)
            problems.setdefault(key, []).extend([r["problem"]] if r["problem"] else [])
        return count, problems

    count, problems = told("entry")
    assert {k for k, n in count.items() if n} == {"good.ttl"} and count["good.ttl"] == 30
    assert all(len(problems[k]) == 1 for k in ("bad.ttl", "faulty.ttl", "latin.ttl", "b.zip", "c.ttl.gz")) and not problems["good.ttl"] and "empty.ttl" not in count
    count, problems = told("statement")
    assert count["good.ttl"] == 30 and count["faulty.ttl"] == 35 and len(problems["faulty.ttl"]) == 1 and problems["faulty.ttl"][0].startswith("line 31")
    assert len(problems["bad.ttl"]) >= 1 and len(problems["b.zip"]) == 1 and len(problems["c.ttl.gz"]) == 1
    with pytest.raises(Exception, match="bad.ttl|faulty.ttl|b.zip|latin"):
        archives.read_dump(spark, str(tmp_path)).count()
    with pytest.raises(Exception, match="strict, entry or statement"):
        archives.read_dump(spark, str(tmp_path), damaged="no").count()


def test_prefixes_of_archives(spark, tmp_path):
    write_zip(tmp_path / "a.zip", [("a.ttl", "@prefix ex: <http://ex/> .\nPREFIX b: <http://b/>\n" * 2), ("b.ttl", "  @prefix ex: <http://ex/> .\n")])
    assert sorted(map(tuple, archives.dump_prefixes(spark, str(tmp_path)).collect())) == [("b", "http://b/", 1), ("ex", "http://ex/", 2)]


def test_memory_of_a_large_file(tmp_path):
    """A gzip file of 200 MB of text and one statement of 30 MB take less than 300 MB."""
    import subprocess
    import sys

    path = tmp_path / "large.ttl.gz"
    line = b'<http://s/0123456789> <http://p/0123456789> "' + b"text " * 380 + b'"@en ; <http://q> <http://o>, 5 .\n'
    with gzip.open(path, "wb", compresslevel=1) as f:
        for _ in range(200_000_000 // len(line)):
            f.write(line)
        f.write(b'<http://long> <http://p> """' + b"l" * 30_000_000 + b'""" .\n')
    code = (
        "import sys;from cairnlake.sources import archives as a;"
        "p=a.plan(sys.argv[1],a.NAMES,a.SPLIT);n=sum(b.num_rows for x in p for b in a.DumpReader({'path':sys.argv[1]}).read(x));"
        "print(n, int(open('/proc/self/status').read().split('VmHWM:')[1].split()[0])//1024)"
    )
    n, mb = map(int, subprocess.run([sys.executable, "-c", code, str(path)], capture_output=True, text=True, check=True).stdout.split())
    assert n == 200_000_000 // len(line) * 3 + 1 and mb < 300, (n, mb)
