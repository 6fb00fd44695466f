"""Settings of the window and training jobs."""

from __future__ import annotations

from dataclasses import dataclass

# The defaults a user of the original batch program relies on.
DEFAULT_WINDOW_SIZE = 20
DEFAULT_STRIDE = 3
DEFAULT_EMBEDDING_DIM = 128
DEFAULT_LINES_PER_GROUP = 10
DEFAULT_WORKERS = 32
DEFAULT_BATCH_SIZE = 10
DEFAULT_AVERAGING_FREQUENCY = 5
DEFAULT_EPOCHS = 20
DEFAULT_LEARNING_RATE = 0.01
DEFAULT_HIDDEN_SIZE = 5
DEFAULT_SEED = 345
DEFAULT_SPLIT_SEED = 1234
DEFAULT_TRAIN_PERCENT = 80

#: Padding that is in no vocabulary, so it embeds to a zero vector. Use "0" for the
#: original numeric padding.
PAD = "<pad>"

#: Token written when a predicted index is not in the vocabulary.
MISSING_TOKEN = "NULL"


@dataclass(frozen=True)
class WindowConfig:
    window_size: int = DEFAULT_WINDOW_SIZE
    stride: int = DEFAULT_STRIDE
    embedding_dim: int = DEFAULT_EMBEDDING_DIM
    #: Classes of the labels; None takes one for each index of the vocabulary.
    vocab_size: int | None = None
    lines_per_group: int = DEFAULT_LINES_PER_GROUP
    pad_token: str = PAD
    #: "standard", "reference" or None (no positional term); training and prediction share it.
    positional: str | None = "standard"
    #: Windows per segment. Bounds the arrays that are collected back per key.
    segment_windows: int = 64

    def __post_init__(self):
        for name in ("window_size", "stride", "embedding_dim", "vocab_size", "lines_per_group", "segment_windows"):
            value = getattr(self, name)
            if value is None and name == "vocab_size":
                continue
            if value < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.positional not in (None, "standard", "reference"):
            raise ValueError(f"unknown positional mode: {self.positional}")

    @property
    def feature_size(self) -> int:
        return self.window_size * self.embedding_dim


@dataclass(frozen=True)
class TrainConfig:
    #: Workers of a round; more are taken where an epoch would have more than most_rounds.
    workers: int = DEFAULT_WORKERS
    batch_size: int = DEFAULT_BATCH_SIZE
    averaging_frequency: int = DEFAULT_AVERAGING_FREQUENCY
    epochs: int = DEFAULT_EPOCHS
    #: The original loop ran one pass more than asked for; True repeats that.
    inclusive_epochs: bool = False
    learning_rate: float = DEFAULT_LEARNING_RATE
    hidden_size: int = DEFAULT_HIDDEN_SIZE
    seed: int = DEFAULT_SEED
    #: Minibatches between two score rows.
    score_every: int = 1
    #: Averaging rounds of an epoch. Rounds follow each other, so their number must not grow with the data.
    most_rounds: int = 256

    @property
    def passes(self) -> int:
        return self.epochs + 1 if self.inclusive_epochs else self.epochs

    def workers_for(self, n_samples: int) -> int:
        """The workers of a round: those asked for, or as many as keep an epoch of n_samples within most_rounds."""
        per_round = self.batch_size * self.averaging_frequency * self.most_rounds
        return max(self.workers, -(-n_samples // per_round))
