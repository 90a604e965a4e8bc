"""daygrid.functions"""
