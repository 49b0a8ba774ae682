"""XML by templates gives what parsing every document gives."""

import random

from topicflow.operators import decode
from topicflow.operators.decode import XmlTemplates, _document_json

VALUES = ["5", "a b", " x", "", " ", "a=", "it's", 'q"q', "&amp;", "&lt;b", "%s", "a%d", "]]", "x>y", "\\n", "é", "\x7f", "\t", "a\tb", "a\nb",
          "", "\x01", "true", "<!--c-->", "<b>1</b>", "<![CDATA[<b>z</b>]]>", "￾"]
SHAPES = [
    '<r a="{}" b="{}"><c>{}</c></r>', "<r><c>{}</c>{}<c>{}</c></r>", "<r>{}</r>", "<r a='{}'><c>{}</c></r>",
    "<r><c>{}</c><d/><c>{}</c><d>{}</d></r>", '<r a="{}">{}</r>', "<r><c>{}</d></r>", '<r a="{}"b="{}"/>',
    '<?xml version="1.0"?><r a="{}"><c>{}</c></r>', '<r xmlns:i="http://www.w3.org/2001/XMLSchema-instance"><c i:nil="{}">{}</c></r>',
    '<r a="{}" a="{}"/>', "<r>{}<c>{}</c>{}</r>", "<r><c>{}</c></r>{}", '<r><c x="1">{}</c></r>', '<r a="{}"><c {}>{}</c></r>',
    '<!DOCTYPE r [<!ENTITY e "{}">]><r>&e;</r>',
]


def test_templates_equal_parsing():
    rng, of = random.Random(1), XmlTemplates()
    for _ in range(40_000):
        shape = rng.choice(SHAPES)
        text = shape.format(*[rng.choice(VALUES) for _ in range(shape.count("{}"))])
        assert of.json(text) == _document_json(text), text
    assert of.json(None) is None


def test_documents_of_one_form_are_parsed_once(monkeypatch):
    parsed, whole = [], decode._document_json
    monkeypatch.setattr(decode, "_document_json", lambda text: parsed.append(text) or whole(text))
    of = XmlTemplates()
    found = [of.json(f'<r a="{i}"><c>{i}</c><d>x</d><c>{i + 1}</c></r>') for i in range(1000)]
    assert found[7] == '{"a":"7","c":["7","8"],"d":"x"}'
    assert len(parsed) < 10
