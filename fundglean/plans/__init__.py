"""Jobs: compositions of sources, expressions and operators."""
