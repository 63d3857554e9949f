from chatterscope.llm.pii import automaton, find


def test_leading_zeros_of_address_parts():
    text = "1.2.3." + "0" * 6000 + "4 1.2.3.256 001.2.3.4"
    assert find(text, automaton()) == [(1, 0, 6007), (1, 6018, 6027)]
