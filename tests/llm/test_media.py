"""Audio, HTML extraction and tool calls: exact round trips, brute force, odd rows."""

from __future__ import annotations

import hashlib
import io
import json
import random
import shutil
import tracemalloc
import wave
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import assert_same

from dirlens.llm import audio, html_extract, tool_calls


def test_payloads_and_files(spark, docs, no_docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = audio.op1_audio_features(spark, str(tmp_path)).collect()
    rows = docs.collect()
    assert len(found) == len(rows)

    def expected(r):
        body = (r["text"] or "").encode()
        payload = body.ljust(max(64, -(-len(body) // 64) * 64), b"\0")
        return (r["doc_id"], len(body), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(payload) + 44, hashlib.sha256(audio.wav(payload)).hexdigest())

    assert sorted((tuple(r)[:7] for r in found), key=repr) == sorted(map(expected, rows), key=repr)
    by_text = {}
    for r in found:
        assert by_text.setdefault(r["payload_sha256"], r["feature"]) == r["feature"]
    assert audio.describe(audio.store(no_docs)).collect() == []


def test_file_is_read_by_the_standard_library():
    payload = bytes(range(256)) * 3
    with wave.open(io.BytesIO(audio.wav(payload))) as f:
        assert (f.getnchannels(), f.getsampwidth(), f.getframerate(), f.readframes(10**6)) == (1, 1, audio.RATE, payload)
    assert audio.samples(audio.wav(payload)) == payload


def test_resampling_is_the_convolution():
    x = np.random.default_rng(1).normal(size=300).astype(np.float32)
    n = -(-len(x) * audio.UP // audio.DOWN)
    expected = []
    for k in range(n):
        centre, phase = k * audio.DOWN // audio.UP, k * audio.DOWN % audio.UP
        expected.append(sum(x[j] * audio.PHASES[phase][j - centre + audio.REACH] for j in range(max(0, centre - audio.REACH), min(300, centre + audio.REACH + 1))))
    assert np.allclose(audio.resample(x, 0, n), expected, atol=1e-5)


def test_a_tone_keeps_its_place_and_pieces_don_t_show():
    t = np.arange(40_000) / audio.RATE
    data = (128 + 100 * np.sin(2 * np.pi * 1000 * t)).astype(np.uint8).tobytes()
    mel = audio.log_mel(data)
    edges = 700 * (10 ** (np.linspace(0, 2595 * np.log10(1 + audio.TARGET / 2 / 700), audio.MELS + 2) / 2595) - 1)
    assert abs(edges[1 + mel[20].argmax()] - 1000) < 120
    before, audio.FRAMES = audio.FRAMES, 7
    try:
        assert np.allclose(audio.log_mel(data), mel, atol=1e-3)
    finally:
        audio.FRAMES = before


def test_segments_have_two_thresholds():
    level = np.array([-60, -5, -15, -15, -60, -15, -60, 0, -60.0])
    assert audio.segments(level) == [(1, 4), (7, 8)]


def test_tensors_are_fixed_shape():
    stream, spans, _ = audio.features(bytes(random.Random(1).randrange(256) for _ in range(20_000)))
    table = pa.ipc.open_stream(stream).read_all()
    assert isinstance(table.schema.field("log_mel").type, pa.FixedShapeTensorType) and table.schema.field("log_mel").type.shape == [audio.CHUNK, audio.MELS]
    assert table.column("start_s")[0].as_py() == 0 and spans and all(a < b for a, b in spans)


SHELL = "<html><head><title>T</title><style>x</style></head><body class='has-sidebar'><nav><ul><li><a href='/a'>Menu</a></ul></nav>{}<footer>&copy; x</footer></body></html>"
CASES = [
    ("<article><h1>A &amp; B</h1><p>one\n two<br>three<p>four <b>bold</b>er</article>", "A & B one two three four bolder"),
    ("<div class=ad>buy</div><main><p>x</p><aside>side</aside><form><p>f</p></form><p>y</main>", "x y"),
    ("<article>x<div class='cookie-notice'>c</div><section id=comments><article>reader</article></section>y</article>", "x y"),
    ("<div class='sidebar-layout'><article>x</article></div><p>outside", "x"),
    ("<p>no main &lt;part&gt;</p><div role=navigation>n</div><script>var a='<p>s</p>';</script><div hidden>h</div>z", "no main <part> z"),
    ("<header>site</header><article><header><h1>head</h1></header>x</article>", "head x"),
    ("<article><p>a < b <i class='x'>c</i></p><!-- no <p>x</p> --><p>d&nbsp;&#233;</p></article>", "a < b c d é"),
    ("<article><script>unclosed", ""),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
    ("", ""),
]


@pytest.mark.parametrize("body,expected", CASES)
def test_main_text(body, expected):
    assert html_extract.Page(SHELL.format(body)).text() == expected


def test_given_pages_by_their_articles(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in html_extract.op10_html_extraction(spark, "/root/testdata/sf0.01").collect():
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1])
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1|br)>", inside)]
        assert r["text"] == " ".join(x for x in blocks if x) and r["n_chars"] == len(r["text"])


def test_style_tree_removes_repeated_branches(spark):
    page = "<body><div class=k1>Same words on all pages</div><div class=k2>Own text {0} <p>more {0}</p></div><div class=k3><span>All</span></div></body>"
    rows = [(i, f"http://a.example.org/{i}", page.format(i), "x", 1) for i in range(12)] + [(20, "http://b.example.org/", page.format(0), "x", 1), (21, None, None, "x", 1), (22, "odd", "", "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path int")
    found = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert [found[i] for i in range(12)] == [f"Own text {i} more {i}" for i in range(12)]
    assert found[20] == "Same words on all pages Own text 0 more 0 All" and found[21] == found[22] == ""
    tree = {r["content"]: r for r in html_extract.style_tree(df.where("page_id < 12")).collect()}
    assert 0.0 in tree and 1.0 in tree
    assert html_extract.extract(df.limit(0)).collect() == []


def plain_importance(pages):
    """(host, path) to pages, presentation, content and importance, from all pages (url, html) at once."""
    hosts = defaultdict(set)
    for url, source in pages:
        page = html_extract.Page(source)
        good = [(t, paths) for t, paths, _, declared, _ in page.blocks if not declared]
        above = {p for _, paths in good for p in paths[1:]}
        shapes = frozenset((p, " ".join(page.children.get(p, [])), p in page.named, 1000 * sum(len(t) for t, paths in good if p in paths) // max(1, sum(len(t) for t, _ in good))) for p in above)
        hosts[url.split("/")[2]].add((tuple((paths[-1], t) for t, paths in good), frozenset(good), shapes))
    out = {}
    for host, distinct in hosts.items():
        nodes = {p for _, _, shapes in distinct for p, *_ in shapes}
        on, shape, texts, named, share = defaultdict(int), defaultdict(Counter), defaultdict(Counter), set(), defaultdict(list)
        parents = {}
        for _, good, shapes in distinct:
            for p, children, is_named, part in shapes:
                on[p] += 1
                shape[p][children] += 1
                if is_named:
                    named.add(p)
                    share[p].append(part / 1000)
            for t, paths in good:
                texts[paths[-1]][t] += 1
                parents[paths[-1]] = paths[1:]

        def entropy(counts, n):
            return -sum(c / n * np.log(c / n) for c in counts) / np.log(n)

        def own(p):
            held = texts[p].values()
            return sum(held) - sum(c * np.log(c) for c in held) / np.log(on[p]) if on[p] > 1 else sum(held)

        for p in nodes:
            presentation = entropy(shape[p].values(), on[p]) if on[p] > 1 else 1.0
            inside = [q for q in texts if p in parents[q]]
            total = sum(sum(texts[q].values()) for q in inside)
            content = max(0.0, sum(map(own, inside)) / total) if total else 0.0
            even = 0.9 ** len(shape[p])
            blend = 0.5 * content * np.mean(share[p]) if p in named else (1 - even) * presentation + even * content
            out[host, p] = (on[p], presentation, content, (on[p] * blend + (p not in named)) / (on[p] + 1))
    return out


def test_importance_is_that_of_a_plain_version(spark):
    rng = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "one more", "all the same"]
    block = lambda: f"<{(t := rng.choice(['div', 'p', 'ul', 'section']))} class={rng.choice(['k', 'l', 'share', 'm', ''])}>{rng.choice(words)}{rng.choice(['', '<div class=n>inner ' + rng.choice(words) + '</div>'])}</{t}>"
    rows = [(f"http://h{i % 3}.example.org/{i}", f"<body>{'<article>' * (i % 2)}{''.join(block() for _ in range(rng.randint(1, 7)))}</body>") for i in range(60)]
    rows += rows[:5]
    found = {(r["host"], r["path"]): (r["pages"], r["presentation"], r["content"], r["importance"]) for r in html_extract.style_tree(spark.createDataFrame(rows, "url string, html string")).collect()}
    expected = plain_importance(rows)
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == pytest.approx(value, abs=1e-9), key


@pytest.mark.parametrize("n", [2, 4, 5, 7])
def test_few_pages_without_an_article(spark, n):
    """A block of an unlisted class that all five pages of a host have goes; with fewer it may be text."""
    rows = [(i, f"http://a.example.org/{i}", f"<body><div class=zq>Read our magazine</div><div class=xv>Own text {i} <p>and {i}</p></div></body>") for i in range(n)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: ("" if n >= 5 else "Read our magazine ") + f"Own text {i} and {i}" for i in range(n)}


def test_a_deep_page_takes_little_memory():
    tracemalloc.start()
    page = html_extract.Page("".join(f"<div>{i}" if i % 100 == 0 else "<div>" for i in range(25_000)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert page.text() == " ".join(str(i) for i in range(0, 25_000, 100)) and peak < 150 << 20


@pytest.mark.parametrize("copies", [7, 8, 1000])
def test_copies_of_a_page_keep_its_text(spark, copies):
    """Equal pages are one page; so are those that differ in declared nodes. Pages without a host aren't judged together."""
    page = "<body><nav>{0}</nav><div class=k><p>One text</p><p>and more</p></div></body>"
    rows = [(i, "http://a.example.org/", page.format(i % 20)) for i in range(copies)] + [(-1 - i, None, f"<body><p>shared words</p><b class=k>own {i}</b></body>") for i in range(12)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: "One text and more" for i in range(copies)} | {-1 - i: f"shared words own {i}" for i in range(12)}


def test_a_page_of_repeated_text_alone_keeps_it(spark):
    rows = [(i, "http://a.example.org/", f"<body><div class=k><p>One text</p></div><div class=date>day {i}</div></body>") for i in range(12)]
    rows += [(12, "http://a.example.org/", "<body><div class=k><p>One text</p></div></body>")]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"day {i}" for i in range(12)} | {12: "One text"}


def test_names_and_main_are_weighed(spark):
    """Repeated blocks go from articles too, teasers are no main text, a named wrapper of all text is kept, named parts go."""
    long = "these are the words of page {0} and some more of them " * 8
    hosts = {
        "a": ("<article><p>Own {0} text</p><div class=k9>Read our magazine</div></article>", "Own {0} text"),
        "b": (f"<div class=k>{long}</div><div class=l><article>teaser {{0}}</article><article>other {{0}}</article></div>", f"{long.strip()} teaser {{0}} other {{0}}"),
        "c": (f"<div class='has-sidebar'><p>{long}</p><div class=ad>buy {{0}}</div></div>", long.strip()),
        "d": (f"<div class=k>{long}</div><div class=comments>reader {{0}} says</div>", long.strip()),
    }
    rows = [(100 * k + i, f"http://{h}.example.org/{i}", f"<body>{body.format(i)}</body>") for k, (h, (body, _)) in enumerate(hosts.items()) for i in range(10)]
    found = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {100 * k + i: text.format(i) for k, (_, text) in enumerate(hosts.values()) for i in range(10)}
    assert html_extract.Page("<div class=has-sidebar>all the text</div>").text() == "all the text"


SCHEMAS = {"add": {"type": "object", "properties": {"a": {"type": "number"}, "b": {"type": "integer"}, "k": {"enum": ["x"]}, "l": {"type": "array", "items": {"type": "string"}}}, "required": ["a"], "additionalProperties": False}}


@pytest.mark.parametrize(
    "value,wrong",
    [({"a": 1}, 0), ({}, 1), ({"a": "1"}, 1), ({"a": True}, 1), ({"a": 1, "b": 1.5}, 1), ({"a": 1, "z": 1}, 1), ({"a": 1, "k": "y"}, 1), ({"a": 1, "l": ["x", 2]}, 1), ([], 1)],
)
def test_arguments_are_validated(value, wrong):
    assert len(tool_calls.faults(value, SCHEMAS["add"])) == wrong


@pytest.mark.parametrize(
    "schema,value,wrong",
    [
        ({"type": ["string", "null"]}, None, 0), ({"type": ["string", "null"]}, 1, 1), ({"enum": [1]}, True, 1), ({"enum": [1]}, 1, 0), ({"type": "integer"}, 10**400, 0), (True, 1, 0), (False, 1, 1),
        ({"type": 5, "required": 3, "properties": 1, "enum": 0}, {"a": 1}, 0), ({"type": "what"}, 1, 0), ({"items": {"items": {"type": "null"}}}, [[None, 1], [2]], 2),
    ],
)
def test_odd_schemas(schema, value, wrong):
    assert len(tool_calls.faults(value, schema)) == wrong


@pytest.mark.parametrize("arguments,good", [("1e999", False), ("NaN", False), ("1.0", True), ("[" * 100_000, False), ("[" * 300 + "]" * 300, False), ('"\\ud800"', True), ("9" * 5000, False)])
def test_odd_arguments(arguments, good):
    """Beyond a float, no JSON, integral, nested deep, half a surrogate, more digits than Python reads."""
    found = tool_calls.parse("assistant", json.dumps({"tool_calls": [call("\ud800", arguments)]}))
    assert (found["calls"][0]["arguments"] is not None) == good and found["calls"][0]["id"] == "\\ud800"
    assert json.loads(found["message"].encode().decode())["tool_calls"][0]["arguments"] == (json.loads(arguments) if good else arguments)


def test_deep_and_odd_texts_are_plain():
    for x in ('{"a":' * 100_000, '{"tool_calls":[], "a":NaN}', "{}", "{", '{"tool_calls": 1}'):
        assert tool_calls.parse("assistant", x)["message"] == tool_calls.canonical({"role": "assistant", "content": x})


def test_tools_of_a_conversation(spark):
    """Schemas from a system message; a call of a tool that the conversation does not declare is at fault."""
    tools = [{"name": "add", "parameters": SCHEMAS["add"]}, {"type": "function", "function": {"name": "any"}}, 5, {"name": 7}]
    calls = json.dumps({"tool_calls": [call("a", {"a": 1}), call("b", {"a": "x"}), call("c", {"z": 1}, "any"), call("d", {}, "none"), call("e", "{", "any")]})
    rows = [(1, 0, "system", json.dumps({"tools": tools})), (1, 1, "assistant", calls), (1, 1, "assistant", calls), (2, 1, "assistant", calls), (None, 1, "assistant", calls)]
    found = tool_calls.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r["conv_id"] or 0, r["n_calls"], r["n_valid"]) for r in found) == [(0, 5, 4), (1, 0, 0), (1, 5, 2), (1, 5, 2), (2, 5, 4)]


def test_sql_of_calls(spark, tmp_path):
    """The query's SQL on a table with calls, results, repeated rows, nulls and broken JSON."""
    rng = random.Random(3)
    rows = []
    for c in range(30):
        ids = [f"k{rng.randint(0, 6)}" for _ in range(rng.randint(0, 5))]
        turns = [("assistant", json.dumps({"tool_calls": [call(i, {"a": rng.randint(0, 9), "b": "é\n"}) if rng.random() < 0.6 else {"id": i, "function": {"name": "f", "arguments": rng.choice(['{"x": 1}', "{", "[]"])}}], **({"content": "hm"} if rng.random() < 0.5 else {})})) for i in ids]
        turns += [("tool", json.dumps({"tool_call_id": f"k{rng.randint(0, 8)}", "content": rng.choice(["r", None, {"x": [1]}])})) for _ in range(rng.randint(0, 5))]
        turns += [("user", "plain"), ("user", None), ("tool", "{}"), (None, '{"tool_calls": []}'), ("user", "{")]
        rng.shuffle(turns)
        rows += [(c if c else None, t if t % 7 else None, *x) for t, x in enumerate(turns)]
    rows += rows[20:30]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "c"))
    next((tmp_path / "c").glob("*.parquet")).rename(tmp_path / "conversations.parquet")
    shutil.rmtree(tmp_path / "c")
    assert_same(tool_calls.op7_chat_tool_calls(spark, str(tmp_path)), tool_calls.SQL, str(tmp_path))


def call(i, arguments, name="add"):
    return {"id": i, "name": name, "arguments": arguments}


def chat(spark):
    calls = lambda *x, **y: json.dumps({"tool_calls": list(x), **y})
    result = lambda i: json.dumps({"tool_call_id": i, "content": f"r{i}"})
    rows = [
        (1, 0, "user", "héllo \"x\"\n"), (1, 1, "tool", result("c2")), (1, 2, "assistant", calls(call("c1", {"b": 2, "a": 1}), call("c2", '{"a": {"$result": "c1"}}'), content="hm")),
        (1, 3, "tool", result("c1")), (1, 4, "tool", result("none")), (1, 5, "assistant", None),
        (2, 0, "assistant", calls(call("d1", {"a": 1, "x": {"$result": "d2"}}))), (2, 1, "assistant", calls({"id": "d2", "function": {"name": "nope", "arguments": "{"}})),
        (2, 2, "tool", result("d2")), (2, 3, "assistant", calls(call("d3", {"a": {"$result": "d1"}}))), (2, 4, "user", "{not json"), (2, 4, "user", "{not json"),
        (3, 0, "assistant", calls(call("e1", {"a": {"$result": "e2"}}))), (3, 1, "assistant", calls(call("e2", {"a": {"$result": "e1"}}))),
        (None, 0, "tool", result("c1")), (4, None, "user", ""),
    ]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, calls long, message string")


def test_calls_are_linked_and_ordered(spark):
    found = tool_calls.link(chat(spark), SCHEMAS).collect()
    assert len(found) == 16
    order = lambda r: (r["order_turn"], r["order_level"], r["order_kind"], r["order_index"], r["turn"])
    turns = lambda c: [r["turn"] for r in sorted((r for r in found if r["conv_id"] == c), key=order)]
    assert turns(1) == [0, 2, 3, 1, 4, 5]
    assert turns(2) == [1, 2, 0, 3, 4, 4]
    assert sorted(turns(3)) == [0, 1]
    by = {(r["conv_id"], r["turn"]): r for r in found}
    assert (by[1, 2]["n_calls"], by[1, 2]["n_answered"]) == (2, 2) and by[1, 3]["linked"] and by[1, 4]["linked"] is False and by[1, 0]["linked"] is None
    assert by[None, 0]["linked"] is False
    assert (by[2, 1]["n_calls"], by[2, 1]["n_valid"], by[2, 0]["n_valid"]) == (1, 0, 0)
    assert json.loads(by[1, 2]["message"])["tool_calls"][0] == {"id": "c1", "name": "add", "arguments": {"a": 1, "b": 2}}
    assert by[1, 0]["message"] == '{"content":"héllo \\"x\\"\\n","role":"user"}' and by[1, 5]["message"] == '{"content":null,"role":"assistant"}'
    assert by[2, 4]["message"] == '{"content":"{not json","role":"user"}'


def test_long_chains_and_cycles_are_ordered(spark):
    """Chains of 40 and 5000 calls, each of which needs the next; a cycle, with messages that need it or it needs."""
    rows = []
    for conv, n in ((1, 40), (2, 5000)):
        rows += [(conv, i, "assistant", json.dumps({"tool_calls": [call(f"c{i}", {"a": {"$result": f"c{i + 1}"}} if i + 1 < n else {})]})) for i in range(n)]
    needs = {0: [3, 8], 1: [2], 2: [], 3: [4], 4: [3, 9], 5: [0, 1], 8: [], 9: []}
    rows += [(3, i, "assistant", json.dumps({"tool_calls": [call(f"c{i}", {"a": [{"$result": f"c{k}"} for k in on]})]})) for i, on in needs.items()]
    found = tool_calls.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    order = lambda r: (r["order_turn"], r["order_level"], r["order_kind"], r["order_index"], r["turn"])
    turns = lambda c: [r["turn"] for r in sorted((r for r in found if r["conv_id"] == c), key=order)]
    assert turns(1) == list(range(39, -1, -1)) and turns(2) == list(range(4999, -1, -1))
    assert turns(3) == [2, 1, 3, 4, 8, 0, 5, 9]


def test_canonical_json_is_stable():
    assert tool_calls.canonical({"b": [1, {"z": 1, "a": "é"}], "a": None}) == '{"a":null,"b":[1,{"a":"é","z":1}]}'


def test_no_chat(spark):
    assert tool_calls.link(chat(spark).limit(0)).collect() == []
