from logilake.functions import dates, geo, text

__all__ = ["dates", "geo", "text"]
