"""Layer tables and served slices, composed from sources, functions and operators."""
