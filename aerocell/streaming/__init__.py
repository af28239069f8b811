"""The pipeline and its operators on streams."""
