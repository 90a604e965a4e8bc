"""daygrid.operators"""
