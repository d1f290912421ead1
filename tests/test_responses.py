import json

from fundglean.functions import responses


def test_unwrap(value):
    body = '{"trustees": [1, 2], "notes": "x"}'
    cases = [
        body,
        f"```json\n{body}\n```",
        f"Sure:\n```json{body}```\nbye",
        f"  {body}\n",
        "```json {broken ``` and more text",
        "```json" + body,
        '```json[1]```',
        "no json in this long answer",
        None,
    ]
    assert value(responses.unwrap_json, cases) == [
        body, f"\n{body}\n", body, body, cases[4], cases[5], cases[6], cases[7], None,
    ]


def test_trustee_count_needs_an_array(value):
    cases = [
        '{"trustees": [{}, {}]}', '{"trustees": []}', '{"trustees": {"a": 1}}',
        '{"trustees": "[1,2]"}', '{"notes": "x"}', "not json", "[1]", None,
    ]
    assert value(responses.trustee_count, cases) == [2, 0, None, None, None, None, None, None]


def test_view_and_dummy(value):
    body = {
        "compensation_info_present": True,
        "trustees": [{"name": "A", "other_compensation": {"fee": "10"}}],
        "notes": "n",
    }
    view = value(responses.response_view, [json.dumps(body)])[0]
    assert view.trustees[0].name == "A"
    assert view.trustees[0].other_compensation == {"fee": "10"}
    dummy = value(responses.unwrap_json, [responses.DUMMY_RESPONSE])[0]
    assert json.loads(dummy)["trustees"] == []


def test_prompt(value):
    filled = value(responses.fill_prompt, ["some $1 text"])[0]
    assert "some $1 text" in filled and responses.SNIPPET_MARK not in filled
