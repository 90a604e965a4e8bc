"""daygrid.sources"""
