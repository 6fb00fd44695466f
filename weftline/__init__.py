"""Text-window analytics and next-token model training as Spark DataFrame jobs."""

from weftline.config import TrainConfig, WindowConfig

__all__ = ["TrainConfig", "WindowConfig"]
