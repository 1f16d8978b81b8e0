"""Factories for model tokenizers whose vocabulary is a file that all executors can read."""

from __future__ import annotations

from collections.abc import Callable


class SentencePiece:
    """A SentencePiece model as chunk tokenizer and, when called, as token counter."""

    def __init__(self, path: str) -> None:
        try:
            import sentencepiece
        except ImportError as error:
            raise ImportError("the sentencepiece package is needed for this tokenizer") from error
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, text: str) -> list:
        return self.model.encode(text)

    def decode(self, tokens: list) -> str:
        return self.model.decode(tokens)

    def __call__(self, text: str) -> int:
        return len(self.encode(text))


def sentencepiece_factory(path: str) -> Callable[[], SentencePiece]:
    """Loads the model in the task, once per iterator of batches."""
    return lambda: SentencePiece(path)
