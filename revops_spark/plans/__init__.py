"""Plans: the registered queries and the staging -> mart build."""
