"""Plans: table specifications and the bronze, silver and gold layers built from them."""
