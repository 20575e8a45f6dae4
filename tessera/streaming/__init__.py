from .incremental import match_batches, match_stream, partial_output, progress, todo
from .lookups import Stop, answers, ask_in_batches

__all__ = ["Stop", "answers", "ask_in_batches", "match_batches", "match_stream", "partial_output", "progress", "todo"]
