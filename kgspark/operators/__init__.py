"""Set-based operators: claims, class graph, joins, merges, checks, media, awards."""
