"""What Python workers keep between the stages of token files."""

from tripspark.llm import token_files


def test_writing_and_reading_forget_the_encoders():
    token_files._ENCODERS["path"] = object()
    assert list(token_files._without_encoders(lambda batches: batches)(iter([1, 2]))) == [1, 2]
    assert not token_files._ENCODERS
