from logilake.operators import dedupe, joins, quality, schema, state

__all__ = ["dedupe", "joins", "quality", "schema", "state"]
