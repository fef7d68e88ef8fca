from logilake.streaming import intake

__all__ = ["intake"]
