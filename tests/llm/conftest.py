"""Helpers of these tests; the session comes from the parent folder."""


def vocabulary(name):
    import public_tokenizers
    return public_tokenizers.path(name)
