from logilake.sources import entities, readers, sinks

__all__ = ["entities", "readers", "sinks"]
