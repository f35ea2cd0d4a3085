"""Source tables in, standard observations out."""
