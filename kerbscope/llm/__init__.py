"""Operations on training text and vectors; see README for the list and the limits of each."""
