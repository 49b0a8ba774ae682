"""An IBAN is found among words in capitals."""

from topicflow.llm import pii


def test_iban_before_and_after_capitals():
    spaced, packed = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    for text, numbers in {
        f"{spaced} BIC": [spaced],
        f"{packed} IN EUR": [packed],
        f"AB12 {spaced} BIC COBADEFF": [spaced],
        f"{spaced} GB82 WEST 1234 5698 7654 32 NOW": [spaced, "GB82 WEST 1234 5698 7654 32"],
        "DE88 3704 0044 0532 0130 00": [],
    }.items():
        assert [text[a:b] for a, b in pii.ibans(text)] == numbers, text
        assert [text[a:b] for kind, a, b, _ in pii.proposals(text) if kind == "iban"] == numbers
