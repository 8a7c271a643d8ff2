"""DataFrame -> DataFrame operators.

Every operator is lazy (no actions), built from Column expressions, and
takes ``keys``: an empty tuple reproduces single-listener semantics, while
``keys=("user_id",)`` runs the same logic independently per listener.
"""
