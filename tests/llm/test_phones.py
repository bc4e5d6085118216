from termdrift.llm.pseudonyms import Pseudonyms


def test_numbers_with_country_code_1_and_no_valid_area_are_replaced():
    there, back = Pseudonyms(b"k"), Pseudonyms(b"k", back=True)
    for i in range(300):
        text = f"call +1 ({i % 200:03}) 555-{i:04} or +1 ({200 + i}) {i % 2}55-{i:04}."
        new, counts = there.replace(text)
        assert counts[3] == 2 and new != text and len(new) == len(text)
        assert back.replace(new) == (text, counts)
