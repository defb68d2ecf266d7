from eventloom.functions import array_payload, dequote, split_lines, wire_text
from eventloom.operators.lines import normalize_lines
from eventloom.sources.text import events_from_array, lines_from_text


def _col(spark, values, expr, schema="t string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(expr).collect()]


def test_split_lines_rules(spark):
    got = _col(spark, ["a\r\nb\rc\n\nlast", "a\n\n", "", "\n", "\r", "x", "a\r\n", None], split_lines("t"))
    assert got == [["a", "b", "c", "", "last"], ["a", ""], [], [""], [""], ["x"], ["a"], None]


def test_wire_text_and_normalize(spark):
    assert _col(spark, ["a\r\nb\rc", "", "z\n"], wire_text("t")) == ["a\nb\nc\n", "", "z\n"]
    df = spark.createDataFrame([(1, "a\rb\r\n")], "id int, t string")
    rows = normalize_lines(df, "t").select("line_no", "line").collect()
    assert [(r.line_no, r.line) for r in rows] == [(0, "a\n"), (1, "b\n")]


def test_array_payload(spark):
    got = _col(spark, [[], ["a", "b"], ["x"]], array_payload("t"), "t array<string>")
    assert got == ["", "a\nb\n", "x\n"]
    df = spark.createDataFrame([(1, ["p", "q"])], "id int, t array<string>")
    assert [(r.pos, r.raw) for r in events_from_array(df, "t").collect()] == [(0, "p"), (1, "q")]


def test_lines_from_text_positions(spark):
    df = spark.createDataFrame([(7, "a\n\nb")], "id int, t string")
    assert [(r.line_no, r.line) for r in lines_from_text(df, "t").collect()] == [(0, "a"), (1, ""), (2, "b")]


def test_dequote(spark):
    got = _col(spark, ['"abc"', '"a"b"', '"', '""', 'x"y"', '"ab"\n', None], dequote("t"))
    assert got == ["abc", 'a"b', '"', "", 'x"y"', '"ab"\n', None]


def test_value_payloads_one_request_per_text(spark):
    from eventloom.operators.batching import value_payloads
    df = spark.createDataFrame([(1, "a\r\nb\rc"), (2, ""), (3, "€\n"), (4, None)], "id int, t string")
    got = {r.id: (r.batch_id, r.n_events, r.n_bytes, r.payload) for r in value_payloads(df, "t", ["id"]).collect()}
    assert got[1] == (0, 3, 6, "a\nb\nc\n")
    assert got[2] == (0, 0, 0, "")
    assert got[3] == (0, 1, 4, "€\n")
    assert got[4][3] is None
    chars = {r.id: r.n_bytes for r in value_payloads(df, "t", ["id"], unit="chars").collect()}
    assert chars[3] == 2


def test_line_feed_in_a_value_becomes_two_wire_lines(spark):
    from eventloom.operators.format import format_events
    df = spark.createDataFrame([(1, "x\ny")], "id int, a string")
    raw = format_events(df, ["a"], ts=False)
    lines = [r.line for r in normalize_lines(raw, "raw").orderBy("line_no").collect()]
    assert lines == ['|a="x\n', 'y"\n']
