from fundglean.functions import paths


def test_accession_and_parse(value):
    names = [
        "edgar/data/1035018/0001193125-20-000327.txt",
        "http://x/edgar/data/7/a.b.txt",
        "edgar/data/blah.txt",
        "",
        None,
    ]
    assert value(paths.accession_from_path, names[:1]) == ["0001193125-20-000327"]
    parsed = value(paths.parse_path, names)
    assert [tuple(p) for p in parsed] == [
        ("1035018", "0001193125-20-000327", "ok"),
        ("7", "a.b", "ok"),
        (None, None, "invalid_path"),
        (None, None, "invalid_path"),
        (None, None, "invalid_path"),
    ]


def test_page_paths(value):
    name = ["edgar/data/1035018/0001193125-20-000327.txt"]
    folder = "edgar/data/1035018/000119312520000327/0001193125-20-000327"
    assert value(paths.index_page_path, name) == [f"{folder}-index.html"]
    assert value(paths.headers_page_path, name) == [f"{folder}-index-headers.html"]


def test_html_paths(value):
    assert value(paths.is_html_path, ["a.htm", "a.html", "a.HTM", "a.htmx"]) == [
        True, True, False, False,
    ]
