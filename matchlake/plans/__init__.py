def registry():
    """All registered queries by name."""
    from matchlake.plans import base, boards, lake, marts  # noqa: F401  (importing registers)

    return base.REGISTRY
